"""The change feed with resets and compaction, deletes with effects, states that end, binary files, the cache, cleanup."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from loremill.operators import lifecycle
from loremill.operators.cache import cached
from loremill.sources import tables
from loremill.streaming import jobs

FEED = "op string, remote_id long, seq long, value string"


def fresh():
    return tempfile.mkdtemp(dir=os.environ["SPARK_TEST_DIR"])


def feed(spark, root, number, rows, schema=FEED):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/part={number}")
    return spark.readStream.schema(schema).parquet(f"{root}/in/part=*")


def now(spark, root):
    return sorted((r.remote_id, r.value) for r in jobs.newest_version(spark, f"{root}/out").collect())


def test_full_listing_ends_older_keys(spark):
    root = fresh()
    for k, rows in enumerate([
        [("upsert", 1, 1, "a"), ("upsert", 2, 2, "b"), ("upsert", 9, 30, "late number")],
        [("full", None, 10, None), ("upsert", 1, 11, "A"), ("upsert", 3, 12, "c")],
        [("upsert", 4, 13, "d"), ("delete", 3, 14, None), ("upsert", 2, 5, "older than the reset"), ("upsert", None, 15, "no key")],
    ]):
        jobs.apply_changes(feed(spark, root, k, rows), f"{root}/out", f"{root}/at")
    want = [(1, "A"), (4, "d"), (9, "late number")]
    assert now(spark, root) == want
    old = jobs.compact_changes(spark, f"{root}/out")
    assert len(old) == 3 and now(spark, root) == want and jobs.compact_changes(spark, f"{root}/out") == []
    # A delete that the base has still beats an older change that comes later.
    jobs.apply_changes(feed(spark, root, 3, [("upsert", 3, 13, "stale"), ("upsert", 5, 20, "e")]), f"{root}/out", f"{root}/at")
    assert now(spark, root) == sorted([*want, (5, "e")])
    jobs.compact_changes(spark, f"{root}/out")
    assert now(spark, root) == sorted([*want, (5, "e")])


def test_a_batch_that_stops_half_way_changes_nothing(spark, monkeypatch):
    root = fresh()
    jobs.apply_changes(feed(spark, root, 0, [("upsert", 1, 1, "a")]), f"{root}/out", f"{root}/at")

    def dies(*args):
        raise RuntimeError("killed")

    stream = feed(spark, root, 1, [("upsert", 1, 2, "b")])
    with monkeypatch.context() as m:
        m.setattr(jobs, "_publish", dies)
        with pytest.raises(Exception, match="killed"):
            jobs.apply_changes(stream, f"{root}/out", f"{root}/at")
    assert now(spark, root) == [(1, "a")]
    jobs.apply_changes(spark.readStream.schema(FEED).parquet(f"{root}/in/part=*"), f"{root}/out", f"{root}/at")
    assert now(spark, root) == [(1, "b")]
    assert len(jobs._live(spark, f"{root}/out")[1]["batches"]) == 2


def test_deletes_with_effects(spark):
    root = fresh()
    docs = spark.createDataFrame([(f"d{k}", k, "t", "p" if k < 4 else "q", f"h{k}", "purged" if k == 3 else "indexed_rag") for k in range(6)], "document_id string, remote_id long, tenant string, project_id string, content_hash string, ingest_state string")
    base = {
        "documents": docs,
        "tombstones": spark.createDataFrame([("t", "p", "h3", "d3", "old")], "tenant string, project_id string, content_hash string, document_id string, reason string"),
        "chunks": spark.createDataFrame([(f"d{k}", f"c{k}{j}", 1.0) for k in range(6) for j in range(2)], "document_id string, chunk_id string, embedding double"),
        "mentions": spark.createDataFrame([(f"c{k}0", "e") for k in range(6)], "chunk_id string, entity_id string"),
        "stale": spark.createDataFrame([("t", "q", "c")], "tenant string, project_id string, community_id string"),
    }

    def state():
        return {k: sorted(map(str, v.collect())) for k, v in jobs.after_deletes(spark, f"{root}/gone", base).items()}

    for k, rows in enumerate([[("delete", 1, 1, None), ("delete", 2, 2, None), ("upsert", 2, 3, "back")], [("delete", 4, 4, None), ("delete", 3, 5, None), ("delete", 77, 6, None)]]):
        jobs.apply_deletes(feed(spark, root, k, rows), docs, f"{root}/gone", f"{root}/at")
    once = state()
    # The last batch again, as after a failure before its commit: the same number, the same folder.
    os.remove(f"{root}/at/commits/1")
    crc = f"{root}/at/commits/.1.crc"
    os.path.exists(crc) and os.remove(crc)
    jobs.apply_deletes(spark.readStream.schema(FEED).parquet(f"{root}/in/part=*"), docs, f"{root}/gone", f"{root}/at")
    assert state() == once and len(once) == 6
    got = jobs.after_deletes(spark, f"{root}/gone", base)
    assert {r.document_id for r in got["documents"].collect() if r.ingest_state == "purged"} == {"d1", "d3", "d4"}
    assert {r.content_hash for r in got["tombstones"].collect()} == {"h1", "h3", "h4"}
    assert {r.chunk_id for r in got["chunks"].collect() if r.embedding is None} == {"c10", "c11", "c40", "c41"}
    assert {r.chunk_id for r in got["mentions"].collect()} == {"c00", "c20", "c30", "c50"}
    assert {(r.document_id, r.chunk_count, r.embeddings_cleared, r.mentions_deleted) for r in got["audit"].collect()} == {("d1", 2, 2, 1), ("d4", 2, 2, 1)}
    assert {(r.project_id, r.community_id) for r in got["stale"].collect()} == {("q", "c"), ("p", "d1")}


def test_states_end(spark):
    root = fresh()
    schema = "document_id long, seq long, state string"
    batches = [[(1, 1, "pending"), (1, 2, "indexed_rag"), (2, 1, "pending"), (2, 3, "purged"), (2, 4, "pending")], [(1, 5, "indexed_graph"), (3, 1, "pending"), (1, 3, "dead_letter"), (4, 1, "purged")]]
    for k, rows in enumerate(batches):
        jobs.track_states(feed(spark, root, k, rows, schema), f"{root}/out", f"{root}/at")
    got = {r.document_id: (r.state, r.n_events) for r in jobs.tracked(spark, f"{root}/out").collect()}
    want = {r.document_id: (r.state, r.n_events) for r in lifecycle.folded_states(spark.createDataFrame([x for b in batches for x in b], schema)).collect()}
    assert got == want == {1: ("indexed_graph", 4), 2: ("purged", 3), 3: ("pending", 1), 4: ("purged", 1)}
    kept = spark.read.format("statestore").option("stateVarName", "now").load(f"{root}/at")
    assert {r.key.document_id for r in kept.select("key").collect()} == {1, 3}


def test_binary_files(spark):
    root = fresh()
    os.makedirs(f"{root}/files/sub")
    files = {"a.txt": b"plain", "sub/b c+d.bin": b"\xff\xfe ok \xc3\xa9", "e.txt": b"", "twin.txt": b"plain"}
    for name, data in files.items():
        with open(f"{root}/files/{name}", "wb") as f:
            f.write(data)
    rows = {r.filename: r for r in tables.read_files(spark, f"{root}/files", F.lit("t"), F.lit("p"), F.lit("s")).collect()}
    assert set(rows) == {"a.txt", "b c+d.bin", "twin.txt"}  # the source passes over empty files
    import hashlib

    for name, data in files.items():
        if not data:
            continue
        r = rows[name.split("/")[-1]]
        assert bytes(r.content) == data and r.size == len(data) and r.content_hash == hashlib.sha256(data).hexdigest() and r.text == data.decode(errors="replace")
    jobs_stream = lambda: tables.file_content(spark.readStream.format("binaryFile").schema(tables.FILES).option("recursiveFileLookup", "true").load(f"{root}/files"), F.lit("t"), F.lit("p"), F.lit("s"))
    for _ in range(2):
        jobs.ingest_new(jobs_stream(), f"{root}/out", f"{root}/at")
    assert sorted(r.filename for r in spark.read.parquet(f"{root}/out").collect()) == ["a.txt", "b c+d.bin"]


def test_a_batch_reads_its_own_shards(spark):
    """However many keys there are, a batch of one document reads the keys of one shard."""
    root = fresh()
    schema = "tenant string, project_id string, source_id string, filename string, content string"
    read = []
    for k in range(3):
        rows = [("t", "p", "s", f"f{k}-{j}", f"content {k} {j}") for j in range(40)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/part={k}")
        jobs.ingest_new(spark.readStream.schema(schema).parquet(f"{root}/in/part=*"), f"{root}/out", f"{root}/at")
        one = spark.createDataFrame([("t", "p", "s", "f", "content 0 7")], schema).withColumn("content_hash", F.sha2(F.col("content").cast("binary"), 256))
        known = jobs.known_keys(one, f"{root}/out", 99)
        read.append(known.count())
        assert known.filter("filename = 'f0-7'").count() == 1
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "shard" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert max(read) <= 6 and spark.read.parquet(f"{root}/out").count() == 120


def test_cache_calls_misses_only(spark):
    root = fresh()
    calls = spark.sparkContext.accumulator(0)

    def work(misses):
        def run(frames):
            for frame in frames:
                calls.add(len(frame))
                yield frame.assign(result="r" + frame["payload"])[["k", "chunks_sha256", "result"]]

        return misses.mapInPandas(run, "k long, chunks_sha256 string, result string")

    rows = lambda n, sha: spark.createDataFrame([(k, sha, f"p{k}{sha}") for k in range(n)], "k long, chunks_sha256 string, payload string")
    one = cached(rows(3, "x"), f"{root}/cache", ["k"], "v1", work)
    assert {(r.k, r.result, r.hit) for r in one.collect()} == {(k, f"rp{k}x", False) for k in range(3)} and one.count() == 3
    assert calls.value == 3
    two = cached(rows(5, "x"), f"{root}/cache", ["k"], "v1", work)
    assert {(r.k, r.hit) for r in two.collect()} == {(k, k < 3) for k in range(5)} and calls.value == 5
    assert cached(rows(5, "x"), f"{root}/cache", ["k"], "v2", work).filter("hit").count() == 0 and calls.value == 10
    assert cached(rows(5, "y"), f"{root}/cache", ["k"], "v1", work).filter("hit").count() == 0 and calls.value == 15
    forced = cached(rows(5, "x"), f"{root}/cache", ["k"], "v1", work, force=True)
    assert forced.filter("hit").count() == 0 and calls.value == 20
    twice = cached(rows(2, "x").union(rows(2, "x")), f"{root}/cache", ["k"], "v1", work)
    assert twice.count() == 4 and twice.filter("hit").count() == 4 and calls.value == 20
    assert cached(rows(0, "x"), f"{root}/none", ["k"], "v1", work).count() == 0


def test_cleanup(spark):
    docs = spark.createDataFrame([("t", "p", "h1", "d1", "pending"), ("t", "p", "h2", "d2", "purged")], "tenant string, project_id string, content_hash string, document_id string, ingest_state string")
    raw = spark.createDataFrame([(f"raw/t/p/s/{h}/f", day) for h, day in (("h1", 1), ("h2", 1), ("h8", 1), ("h9", 9))] + [("raw/t/q/s/h9/f", 1)], "key string, modified int")
    lines = spark.createDataFrame([("m1", "d1", 1), ("m1", "d2", 1), ("m2", "d2", 1), ("m2", None, 1), ("m3", "d7", 9)], "key string, document_id string, modified int")
    found = lifecycle.cleanup_candidates(raw, lines, docs, F.lit("p"), F.lit(5), F.lit(5))
    assert sorted(map(tuple, found.collect())) == [("orphan_raw", "raw/t/p/s/h8/f"), ("stale_manifest", "m2")]
    every = lifecycle.cleanup_candidates(raw, lines, docs, F.lit("p"))
    report = {r.kind: (r.candidate_count, r.deleted_count, list(r.shown)) for r in lifecycle.cleanup_report(every).collect()}
    assert report == {"orphan_raw": (2, 0, ["raw/t/p/s/h8/f", "raw/t/p/s/h9/f"]), "stale_manifest": (2, 0, ["m2", "m3"])}
    assert {r.deleted_count for r in lifecycle.cleanup_report(every, dry_run=False).collect()} == {2}
