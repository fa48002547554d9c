"""The pipeline's stages on planted documents, each against what it must keep and drop."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

import corpus_pipeline
from loremill.llm.shared import cut, table
from tests.llm.test_llm_operators import DOCS, SF, classes, prose


def test_stages(spark):
    rng = random.Random(11)
    good = lambda n=90: ". ".join(" ".join(prose(rng, 9)).capitalize() for _ in range(n // 9)) + "."
    texts = {k: good() for k in range(100_000, 100_040)}
    texts[200_001] = texts[100_003]
    near = texts[100_005].split()
    near[40] = "changed"
    texts[200_002] = " ".join(near)
    passage = good(72)
    texts[200_003], texts[200_004] = good(81) + " " + passage, good(81) + " " + passage
    texts[200_005] = "BUY!!! ### $$$ " * 60
    given = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()] + [(None, texts[100_010], "en", "s", 1), (200_006, None, "en", "s", 0), (100_020, texts[100_020], "en", "s", 9)], DOCS)
    docs = given.unionByName(table(spark, SF, "documents"))
    base = {r.doc_id for r in table(spark, SF, "documents").collect()}

    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5 and corpus_pipeline.ORACLE_SQL is None
    a = cut(stages["quality_classifier"](spark, docs, SF))
    kept = {r.doc_id for r in a.collect()}
    assert a.columns == docs.columns and 200_005 not in kept
    assert len({i for i in texts if i not in kept} - {200_005}) <= 2

    b = cut(stages["exact_dedup"](spark, a, SF))
    rows = [(r.doc_id, r.text) for r in b.collect()]
    want = {}
    for r in a.collect():
        t = r.text or ""
        want[t] = max(want.get(t, -1), -1 if r.doc_id is None else r.doc_id)
    assert sorted((t or "", -1 if i is None else i) for i, t in rows) == sorted(want.items())

    c = cut(stages["near_dedup"](spark, b, SF))
    own = sorted((i, t or "") for i, t in rows if i is not None and (i >= 100_000 or i not in base))
    top = classes([t for _, t in own])
    left = {r.doc_id for r in c.collect()}
    assert {i for i, _ in own} & left == {own[k][0] for k in set(top)}

    d = cut(stages["substring_dedup"](spark, c, SF))
    after = {r.doc_id: r.text for r in d.collect()}
    assert d.columns == docs.columns
    assert {200_003, 200_004} <= left
    assert passage[20:200] in after[200_003] and passage[20:200] not in after[200_004]
    assert all(after[i] == texts[i] for i in range(100_000, 100_040) if i in after)

    e = stages["best_fit_packing"](spark, d, SF).collect()
    assert {r.doc_id for r in e} == set(after)
    assert all(r.offset + r.length <= 2048 for r in e)


def test_clashing_columns(spark):
    """Documents may have columns of any names that stages use inside; they come through unchanged."""
    names = ["_sha", "sha", "kept_id", "kept_sha", "spans", "passage_id", "rest", "left", "id", "rep", "row", "doc", "own", "text_mark", "text_hash", "score", "low", "high"]
    rng = random.Random(5)
    texts = [". ".join(" ".join(prose(rng, 9)).capitalize() for _ in range(9)) + "." for _ in range(12)]
    texts += [texts[0], texts[1] + " " + texts[2]]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = cut(stage(spark, docs, SF))
        rows = docs.collect()
        assert rows and docs.columns[-len(names) :] == names, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names), name


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        assert cut(stage(spark, docs, SF)).count() == 0, name
