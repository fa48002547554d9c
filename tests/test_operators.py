"""Unit cases of operators, with inputs of our own."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from loremill.functions import ids, splitting, text as X
from loremill.operators import adapters, communities, graph, ingest, lifecycle, search
from loremill.operators.components import components
from loremill.sources import tables


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def test_identifiers(spark):
    ns = uuid.UUID(ids.NAMESPACE)
    for name in ("a", "Zürich", "한국", "x" * 200):
        assert one(spark, ids.uuid5("v"), v=name) == str(uuid.uuid5(ns, name))
        assert one(spark, ids.entity_id("v"), v=f" {name} ") == str(uuid.uuid5(ns, f"entity:{name}"))
        assert one(spark, ids.entity_ref("v"), v=f"entity:{name}") == one(spark, ids.entity_ref("v"), v=name)
    given = str(uuid.uuid4())
    assert one(spark, ids.entity_ref("v"), v=given) == given
    assert one(spark, ids.entity_id("v"), v="  ") is None
    assert one(spark, ids.document_id("t", "p", "c"), t="", p="p", c="c") is None


def test_names_and_paths(spark):
    assert one(spark, X.slug_of_name("v"), v=" My Project! ") == "my_project"
    assert one(spark, X.slug_of_name("v"), v="한글").startswith("p_")
    assert one(spark, X.path_segment("v"), v=" / ") == "community"
    assert one(spark, X.path_segment("v"), v="a b/c") == "a-b-c"
    assert one(spark, X.url_filename("v"), v="https://x.org/a/b.html?q=1") == "b.html"
    assert one(spark, X.url_filename("v"), v="") == "index.html"
    assert one(spark, X.url_filename("v"), v="https://x.org/?q=1") == "download.bin"
    assert one(spark, X.suffix("v"), v="a/b.tar.GZ") == ".gz"
    assert one(spark, X.suffix("v"), v=".bashrc") == ""
    assert one(spark, X.extensions("v"), v="pdf, .MD,,") == [".md", ".pdf"]
    assert one(spark, X.truncated("v", 5), v="abcdefgh") == "abcd…"
    assert one(spark, X.clean_path("v"), v="//a///b/") == "/a/b"
    assert one(spark, X.parent_path("v"), v="/a") == "/"


def test_cleaning(spark):
    assert one(spark, X.clean_chunk("v"), v="가\n나 a\nb  \\emph{x}\x07") == "가나 ab x"
    assert one(spark, X.clean_field("v"), v="one\ntwo  12}],\"") == "one two"
    assert one(spark, X.clean_field("v"), v="e\u0301") == "é"
    assert one(spark, X.json_payload("v"), v='{"output": {"a": 1}}') == '{"a":1}'


@pytest.mark.parametrize(
    "query, mode",
    [("[[Acme]] history", "local"), ("give me an Overview", "global"), ("Acme Corp", "local"), ("größe", "local"), ("what is it", "basic"), ("a b c d e f g h", "drift")],
)
def test_mode_router(spark, query, mode):
    assert one(spark, X.search_mode("v", F.lit("auto")), v=query) == mode
    assert one(spark, X.search_mode("v", F.lit("drift")), v=query) == "drift"


def test_cut_long(spark):
    cut = lambda t, n: one(spark, splitting.cut_long("v", n), v=t)
    assert cut("a" * 2500, 1000) == ["a" * 1000, "a" * 1000, "a" * 500]
    assert cut("x" * 1000, 1000) == ["x" * 1000]
    assert cut(" short ", 1000) == [" short "] and cut("", 9) == [""]
    # A line end exactly at a third of the window counts, one before it does not; a line end goes before a later blank.
    assert cut("a" * 3 + "\n" + "b" * 9, 9)[0] == "aaa"
    assert cut("aa\n" + "b" * 9, 9)[0] == "aa\nbbbbbb"
    assert cut("aaaa\nb c dddd", 9) == ["aaaa", "b c dddd"]
    assert cut("aaaa b c dddd", 9) == ["aaaa b c", "dddd"]
    assert cut("\U0001f600" * 7, 3) == ["\U0001f600" * 3, "\U0001f600" * 3, "\U0001f600"]
    assert cut("a" * 9 + "   \n ", 9) == ["a" * 9]
    assert one(spark, splitting.cut_long(F.lit(None).cast("string"), 9)) == []
    pack = lambda t, n: one(spark, splitting.pack_paragraphs("v", n), v=t)
    assert pack("aa\n\nbb\n\ncc", 6) == ["aa\n\nbb", "cc"]
    assert pack("  ", 5) == []
    assert pack("a" * 7 + "\n\nb", 5) == ["aaaaa", "aa\n\nb"]


def test_halves():
    assert splitting.halves("one\n\ntwo") == ["one", "two"]
    assert splitting.halves("a\nbb\nccc\ndddd") == ["a\nbb", "ccc\ndddd"]
    assert splitting.halves("x\ny\n\n" + "z" * 30) == ["x\ny", "z" * 30]
    assert splitting.halves("abcde") == ["ab", "cde"]
    assert splitting.halves("") == ["", ""]


def test_markdown_blocks():
    text = "# A\ntext one\n\ntext two\n\n\nlater\n## B\n| x | y |\n|---|---|\n| 1 | 2 |\nHead\n====\n**Bold**\n| lone |\n"
    got = [(b["type"], b["text"], b["heading_path"]) for b in splitting.markdown_blocks(text)]
    assert got == [
        ("heading", "A", ["A"]),
        ("paragraph", "text one\n\ntext two", ["A"]),
        ("paragraph", "later", ["A"]),
        ("heading", "B", ["A", "B"]),
        ("table", "| x | y |\n|---|---|\n| 1 | 2 |", ["A", "B"]),
        ("heading", "Head", ["Head"]),
        ("heading", "Bold", ["Head", "Bold"]),
        ("paragraph", "| lone |", ["Head", "Bold"]),
    ]
    with pytest.raises(KeyError, match="known: markdown"):
        splitting.extractor("nope")


@pytest.mark.parametrize(
    "text, want",
    [
        # Siblings take each other's place in the path; deeper headings go with their parent.
        ("# A\n## B\n### C\nc\n## D\nd\n# E\ne", [("heading", ["A"]), ("heading", ["A", "B"]), ("heading", ["A", "B", "C"]), ("c", ["A", "B", "C"]), ("heading", ["A", "D"]), ("d", ["A", "D"]), ("heading", ["E"]), ("e", ["E"])]),
        # Rows without a rule are a table if all begin with a bar; one row alone is none.
        ("| a | b |\n| c | d |\n\n| e |", [("table", []), ("| e |", [])]),
        ("a | b\n--- | ---\nc", [("a | b", []), ("--- | ---", []), ("c", [])]),
        # The line under a title is used up: a second one is text.
        ("Title\n---\n---\nbody", [("heading", ["Title"]), ("---\nbody", ["Title"])]),
        ("**B**  \n** **\nx", [("heading", ["B"]), ("** **\nx", ["B"])]),
        ("one\n\n\n\ntwo\n \nthree  ", [("one", []), ("two\n\nthree", [])]),
        ("#no heading\n####### seven", [("#no heading\n####### seven", [])]),
        ("", []), ("\n \n", []),
    ],
)
def test_markdown_cases(text, want):
    got = [(b["text"] if b["type"] == "paragraph" else b["type"], b["heading_path"]) for b in splitting.markdown_blocks(text)]
    assert got == want


def test_layout_blocks(spark):
    rows = [
        ("d", 0, "caption", "Fig 1", None), ("d", 1, "title", "Intro", None), ("d", 2, "picture", "", None), ("d", 3, "text", "body", None),
        ("d", 4, "picture", "", None), ("d", 5, "text", "- 3 -", None), ("d", 6, "text", "2. Next", None), ("d", 7, "table", "t", "|a|"), ("d", 8, "picture", "", None),
    ]
    df = spark.createDataFrame(rows, "document_id string, pos int, boxclass string, text string, table_markdown string").withColumn("caption", F.lit(None).cast("string"))
    got = [(r.type, r.text, r.heading_path) for r in ingest.layout_blocks(df).orderBy("pos").collect()]
    assert got == [("image", "Fig 1", ["Intro"]), ("paragraph", "body", ["Intro"]), ("table", "|a|", ["2. Next"])]


def test_elements(spark):
    rows = [("d", k, t, x, None) for k, (t, x) in enumerate([("FigureCaption", "alone"), ("Title", "T"), ("Image", ""), ("FigureCaption", "one"), ("FigureCaption", "two"), ("Footer", "f"), ("Table", ""), ("ListItem", "li")])]
    df = spark.createDataFrame(rows, "document_id string, pos int, type string, text string, text_as_html string")
    got = [(r.type, r.text, r.caption, r.heading_path) for r in ingest.element_blocks(df).orderBy("pos").collect()]
    assert got == [("paragraph", "alone", None, []), ("heading", "T", None, ["T"]), ("image", None, "two", ["T"]), ("list_item", "li", None, ["T"])]
    assert one(spark, ingest.bounding_box(F.array(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(1.0), F.lit(9.0))))) == [1.0, 4.0, 3.0, 9.0]


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 10), (10, 11), (11, 12), (12, 13), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, **dict.fromkeys(range(8, 14), 8)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_communities(spark):
    edges = [(f"{c}{i}", f"{c}{j}", 1.0) for c in "abc" for i in range(5) for j in range(i)] + [("a0", "b0", 0.1), ("x", "y", 1.0)] + [(f"s{i}", "hub", 1.0) for i in range(14)]
    df = spark.createDataFrame(edges, "source string, target string, weight double")
    rows = communities.detect(df).collect()
    nodes = {n for e in edges for n in e[:2]}
    assert {r.node for r in rows if r.level == 0} == nodes and len([r for r in rows if r.level == 0]) == len(nodes)
    clusters = {}
    for r in rows:
        clusters.setdefault((r.level, r.cluster_key, r.parent_key), set()).add(r.node)
    at = lambda n, level: next(c for (lv, _, _), c in clusters.items() if lv == level and n in c)
    assert at("a0", 0) == {f"a{i}" for i in range(5)} and at("x", 0) == {"x", "y"}
    for (level, key, parent), own in clusters.items():
        assert key == min(own)
        if parent is not None:
            assert own <= next(c for (lv, k, _), c in clusters.items() if lv == level - 1 and k == parent)
    deepest = {n: max(r.level for r in rows if r.node == n) for n in nodes}
    assert all(len(c) <= communities.MAX_SIZE for (lv, _, _), c in clusters.items() if all(deepest[n] == lv for n in c))
    again = communities.detect(df.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_rank_values(spark):
    texts = spark.createDataFrame([("1", "alpha beta"), ("2", "alpha"), ("3", "alpha x y beta alpha"), ("4", "")], "id string, text string")
    q = spark.createDataFrame([(1, "Alpha"), (2, "alpha beta"), (3, "!!")], "query_id long, query string")
    got = {(r.query_id, r.id): (round(r.score, 7), r["rank"]) for r in search.full_text(q, texts).collect()}
    assert got[1, "2"][0] == 0.0607927
    assert got[2, "1"][0] == 0.0991032
    assert got[1, "3"] == (round(0.1 * 1.25 / 1.64493406685, 7), 1)
    assert {k for k in got if k[0] == 3} == set()


def test_fusion(spark):
    rows = [(1, 0, 1, "a", "first"), (1, 0, 2, "b", "p"), (1, 1, 1, "b", "q"), (1, 1, 2, "c", "r"), (1, 1, 3, None, "z")]
    df = spark.createDataFrame(rows, "query_id long, channel int, rank int, id string, text string")
    got = [(r.id, r.text) for r in search.fuse(df, payload=["text"]).orderBy("rank").collect()]
    assert got == [("b", "p"), ("a", "first"), ("c", "r")]


def test_upsert_and_states(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, text string, e double")
    new = spark.createDataFrame([(2, "B", None), (3, "c", 3.0)], "id long, text string, e double")
    got = {r.id: (r.text, r.e) for r in tables.upsert(old, new, ["id"], ["text", "e"], ["e"]).collect()}
    assert got == {1: ("a", 1.0), 2: ("B", 2.0), 3: ("c", 3.0)}
    twice = tables.upsert(tables.upsert(old, new, ["id"], ["text", "e"], ["e"]), new, ["id"], ["text", "e"], ["e"])
    assert {r.id: (r.text, r.e) for r in twice.collect()} == got
    ev = spark.createDataFrame([(1, 1, "pending"), (1, 3, "indexed_rag"), (2, 1, "purged"), (2, 2, "pending")], "document_id long, seq long, state string")
    assert {r.document_id: r.state for r in lifecycle.folded_states(ev).collect()} == {1: "indexed_rag", 2: "purged"}


def test_scope_and_co_mentions(spark):
    edges = spark.createDataFrame([("EXTRACTED", "a", "b"), ("INFERRED", "b", "c"), ("MENTIONS", "a", "c")], "type string, source string, target string")
    ab = spark.createDataFrame([("a",), ("b",)], "id string")
    assert graph.scoped_edges(edges, ab).count() == 1
    assert graph.scoped_edges(edges, None).count() == 2
    assert graph.scoped_edges(edges, ab.filter("false")).count() == 0
    m = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c1", "b"), ("c2", "b"), ("c2", "c")], "chunk_id string, entity_id string")
    assert sorted((r.source, r.target) for r in graph.co_mentions(m).collect()) == [("a", "b"), ("b", "c")]


def test_extraction_splits(spark):
    def extract(text):
        if len(text) > 500:
            raise adapters.TooLong
        return adapters.wikilink_extractor(text)

    long = " [[A]] ".join(["x" * 300] * 3) + "\n\n" + "[[B]]" + "y" * 300
    df = spark.createDataFrame([("p", long), ("q", None)], "id string, text string")
    entities, edges = adapters.extract_graph(df.withColumnRenamed("id", "prompt"), "prompt", "text", extract)
    assert {r.name for r in entities.collect()} >= {"B"} and edges.count() == 0
    with pytest.raises(Exception, match="embedder returned"):
        adapters.embed_texts(df, "id", "text", lambda t: [[0.0] * 3] * len(t), dim=64).collect()


def test_manifest_limits(spark):
    items = spark.createDataFrame([("t", "p", "s", "h", "u", "f", "d", "m")], "tenant string, project_id string, source_id string, content_hash string, s3_raw_uri string, filename string, document_id string, mime string")
    assert tables.batch_manifest(items, "b").columns == [*tables.MANIFEST, "batch_id"]
    with pytest.raises(ValueError):
        tables.batch_manifest(items, "b", 101)


def test_local_and_drift_search(spark):
    from loremill.plans import retrieval

    entities = spark.createDataFrame([("e1", "Acme", "maker of anvils"), ("e2", "Road", "where things run")], "id string, name string, description string")
    edges = spark.createDataFrame([("EXTRACTED", "e1", "e2", 1.0, "sells on")], "type string, source string, target string, confidence double, description string")
    texts = spark.createDataFrame([("c1", "d1", "acme acme anvils"), ("c2", "d1", "nothing here"), ("c3", "d2", "an acme day")], "id string, document_id string, text string")
    mentioned = spark.createDataFrame([("c2", "e1"), ("c3", "e1")], "chunk_id string, entity_id string")
    q = spark.createDataFrame([(1, "acme", ["road", " ", "acme"]), (2, "zzz", None)], "query_id long, query string, sub_queries array<string>")
    got = retrieval.local_search(q, entities, edges, texts, mentioned).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {1} and [r["rank"] for r in got] == list(range(1, len(got) + 1))
    assert {r.id for r in got} == {"e1", "c1", "c2", "c3", "e1->e2"} and got[-1].kind == "relationship"
    assert '"entity_ids":["e1"]' in next(r.provenance for r in got if r.id == "c2")
    pages = spark.createDataFrame([("p1", "k1", "Acme page", "body acme", "Acme page\nbody acme", "/wiki/p1.md")], "slug string, community_id string, title string, body_text string, search_text string, vfs_path string")
    primer = retrieval.global_search(q, pages, spark.createDataFrame([("k1", True)], "community_id string, stale boolean"))
    assert [(r.id, '"stale":true' in r.provenance) for r in primer.collect()] == [("p1", True)]
    drift = retrieval.drift_search(q, primer, lambda df: retrieval.local_search(df, entities, edges, texts, mentioned))
    assert {"p1", "e1", "e2"} <= {r.id for r in drift.collect()}


def test_drift_depth(spark):
    """At depth 2 a basic list follows each local one; an id in both counts twice."""
    from loremill.plans import retrieval

    hit = "query_id {}, rank int, id string, rrf_score double, kind string, text string, provenance string"
    q = spark.createDataFrame([(1, "q", [" a ", "", "b", "c", "d"]), (2, "only", None)], "query_id long, query string, sub_queries array<string>")
    primer = spark.createDataFrame([(1, k, f"p{k}", 0.1, "wiki", "t", "{}") for k in range(1, 6)], hit.format("long"))
    asked = []

    def run(kind):
        def search_(df):
            rows = df.collect()
            asked.append((kind, sorted(r["query"] for r in rows)))
            return spark.createDataFrame([(r.query_id, 1, f"{kind}:{r['query']}", 0.1, kind, "t", "{}") for r in rows] + [(r.query_id, 2, "both", 0.1, kind, "t", "{}") for r in rows], hit.format("string"))

        return search_

    got = retrieval.drift_search(q, primer, run("local"), run("basic"), top_k=50).collect()
    assert asked == [("local", ["a", "b", "c", "only"]), ("basic", ["a", "b", "c", "only"])]
    one = {r.id: r for r in got if r.query_id == 1}
    assert set(one) == {"p1", "p2", "p3", "both", *(f"{k}:{x}" for k in ("local", "basic") for x in "abc")}
    assert one["both"].rrf_score == pytest.approx(6 / 62) and one["both"]["rank"] == 1 and one["both"].kind == "local"
    alone = retrieval.drift_search(q, primer, run("local"), run("basic"), depth=1).collect()
    assert not [r for r in alone if r.kind == "basic"]


def test_change_feed_order(spark):
    """A change that is older than what a table has changes nothing, whenever it comes; a batch run again changes nothing either."""
    import tempfile

    from loremill.streaming import jobs

    root = tempfile.mkdtemp(dir=os.environ["SPARK_TEST_DIR"])
    schema = "op string, remote_id long, seq long, value string"
    for k, rows in enumerate([[("upsert", 1, 5, "new"), ("upsert", 2, 1, "x"), ("upsert", 3, 1, "y")], [("upsert", 1, 2, "old"), ("delete", 2, 4, None), ("upsert", 3, 9, "z")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/part={k}")
        jobs.apply_changes(spark.readStream.schema(schema).parquet(f"{root}/in/part=*"), f"{root}/out", f"{root}/at")
        jobs.apply_changes(spark.readStream.schema(schema).parquet(f"{root}/in/part=*"), f"{root}/out", f"{root}/at")
    assert sorted((r.remote_id, r.value) for r in jobs.newest_version(spark, f"{root}/out").collect()) == [(1, "new"), (3, "z")]


def test_groups_and_fingerprints_in_shares(spark):
    """Group numbers are those of one sort of the whole batch; fingerprints do not see the order of lines."""
    rows = [("t" if k % 3 else "u", uuid.uuid5(uuid.NAMESPACE_URL, str(k // 4)).hex, k % 4, "text" if k % 7 else " ") for k in range(500)]
    df = spark.createDataFrame(rows, "tenant string, document_id string, chunk_index int, text string").repartition(7)
    got = {(r.tenant, r.document_id, r.chunk_index): r.group for r in lifecycle.prompt_groups(df, ["tenant"], ["document_id", "chunk_index"], 20).collect()}
    for tenant in "tu":
        own = sorted((d, c) for t, d, c, x in rows if t == tenant and x.strip())
        assert [got[tenant, *x] for x in own] == [k // 20 for k in range(len(own))]
    assert len(got) == sum(x.strip() != "" for *_, x in rows)
    print_ = lambda f: {(r.tenant, r.chunks_sha256, r.n_lines) for r in lifecycle.fingerprints(f, ["tenant"], F.concat_ws(" ", "document_id", "chunk_index")).collect()}
    assert print_(df) == print_(df.orderBy(F.desc("document_id"))) != print_(df.filter("chunk_index < 3"))


def test_purge_marks(spark):
    """One mark for each project that loses documents and has none yet; a source's documents that are not gone are wanted."""
    docs = spark.createDataFrame([("t", "p", "d2", "s"), ("t", "p", "d1", "s"), ("t", "q", "d3", "s")], "tenant string, project_id string, document_id string, source_id string")
    stale = spark.createDataFrame([("t", "q", "c9")], "tenant string, project_id string, community_id string")
    assert sorted(map(tuple, lifecycle.mark_stale(stale, docs).collect())) == [("t", "p", "d1"), ("t", "q", "c9")]
    states = docs.withColumn("ingest_state", F.when(F.col("document_id") == "d1", "purging").otherwise("pending"))
    assert [r.document_id for r in lifecycle.wanted_of(states, F.lit("p"), "s").collect()] == ["d2"]
    assert lifecycle.wanted_of(states, F.lit("p"), "other").count() == 0


def test_shared_folder_on_a_cluster():
    from loremill.operators.components import shared_dir

    class Conf(dict):
        set = dict.__setitem__

    session = lambda **conf: type("S", (), {"conf": Conf({k.replace("_", "."): v for k, v in conf.items()})})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(spark_master="spark://host:7077"))
    assert shared_dir(session(spark_master="yarn", spark_checkpoint_dir="hdfs:///x/")) == "hdfs:///x"
