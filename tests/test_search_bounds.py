"""Exact search that need not look at everything: cells of vectors, bounds of full-text matches."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loremill.operators import search, vectors

KINDS = "id long, scope string, vector array<double>"


def brute(queries, items, limit):
    out = {}
    for q, scope, x in queries:
        if x is None or not np.linalg.norm(x):
            continue
        own = [(-round(float(np.dot(x, v) / np.linalg.norm(x) / np.linalg.norm(v)), 9), i) for i, s, v in items if v is not None and np.linalg.norm(v) and (scope is None or s == scope)]
        out |= {(q, i): (k + 1, -c) for k, (c, i) in enumerate(sorted(own)[:limit])}
    return out


@pytest.mark.parametrize("k, block, asks", [(12, 4096, 1024), (1, 50, 3), (40, 30, 2)])
def test_cells_find_what_a_scan_finds(spark, monkeypatch, k, block, asks):
    monkeypatch.setattr(vectors, "VECTORS", block)
    monkeypatch.setattr(vectors, "QUERIES", asks)
    rng = np.random.default_rng(k)
    middle = rng.normal(size=(10, 6)) * 4
    items = [(i, rng.choice([None, "a", "b"]), [float(x) for x in middle[i % 10] + rng.normal(size=6)]) for i in range(600)]
    items += [(1000 + i, "a", items[0][2]) for i in range(30)] + [(2000, "a", [0.0] * 6), (2001, "a", None)]  # ties, no direction, null
    asked = [(q, None if q % 3 else rng.choice(["a", "b", "c"]), v) for q, _, v in items[::29]] + [(5000, None, [0.0] * 6), (5001, None, None), (5002, None, [-x for x in items[3][2]])]
    df = spark.createDataFrame([(i, s, v) for i, s, v in items], KINDS).repartition(3)
    q = spark.createDataFrame([(i, s, v) for i, s, v in asked], KINDS).withColumnRenamed("id", "query_id")
    index = vectors.cells(df, k)
    found, looked = vectors.nearest(q, index, 5)
    got = {(r.query_id, r.id): (r["rank"], round(r.score, 9)) for r in found.collect()}
    assert got == brute(asked, items, 5)
    if k > 1:
        share = looked.agg(F.sum("n")).first()[0] / (len(asked) * len(items))
        print("share of pairs scored", share)
        assert share < 0.6
    assert looked.groupBy("query_id", "scope", "cell").count().filter("count > 1").isEmpty()


def test_cells_odd(spark):
    df = spark.createDataFrame([(1, None, [1.0, 0.0])], KINDS)
    q = df.withColumnRenamed("id", "query_id")
    assert search.vector_top(q, df, 3).count() == 1
    assert search.vector_top(q.limit(0), df, 3).count() == 0
    assert search.vector_top(q, df.limit(0), 3).count() == 0


def test_cells_on_the_given_vectors(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    df = e.select(F.col("vec_id").alias("id"), F.lit(None).cast("string").alias("scope"), F.col("embedding").alias("vector"))
    q = df.filter("id % 100 = 0").withColumnRenamed("id", "query_id")
    found, looked = vectors.nearest(q, vectors.cells(df), 10)
    rows = df.toPandas()
    m = np.stack(rows["vector"].to_numpy()).astype(float)
    m /= np.linalg.norm(m, axis=1)[:, None]
    at = {v: k for k, v in enumerate(rows["id"])}
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.id] = r["rank"]
    for query, own in got.items():
        order = sorted(zip(-np.round(m @ m[at[query]], 9), rows["id"]))[:10]
        assert own == {i: k + 1 for k, (_, i) in enumerate(order)}
    print("share of pairs scored", looked.agg(F.sum("n")).first()[0] / (len(got) * len(m)))


def test_bounds_score_fewer_and_find_the_same(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta"] + [f"w{k}" for k in range(30)]
    texts = [(i, " ".join(rng.choices(words, [9, 5, 2, 1, *[1] * 30], k=rng.randint(3, 60)))) for i in range(900)]
    queries = [(0, "alpha"), (1, "alpha beta"), (2, "alpha beta gamma"), (3, "delta w3 alpha"), (4, "missing alpha"), (5, "?!"), (6, "beta Beta")]
    t, q = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(queries, "query_id long, query string")
    found, scored = search.bounded_top(q, t, 5)
    got = {(r.query_id, r.id): (r["rank"], round(r.score, 9)) for r in found.collect()}

    want, matches = {}, 0
    for query, asked in queries:
        terms = sorted({w.lower() for w in asked.replace("?!", "").split()})
        scores = []
        for i, text in texts:
            places = [[k for k, w in enumerate(text.split()) if w == term] for term in terms]
            if not terms or not all(places):
                continue
            matches += len(terms) > 1
            if len(terms) == 1:
                score = 0.1 * sum(1 / (j * j) for j in range(1, len(places[0]) + 1)) / 1.64493406685
            else:
                rest = 1.0
                for a in range(len(terms)):
                    for b in range(a + 1, len(terms)):
                        for x in places[a]:
                            for y in places[b]:
                                d = abs(x - y)
                                rest *= 1 - (1e-30 if d > 100 else (0.01 / (1.005 + 0.05 * np.exp(d / 1.5 - 2))) ** 0.5)
                score = 1 - rest
            scores.append((-round(score, 9), i))
        want |= {(query, i): (k + 1, -s) for k, (s, i) in enumerate(sorted(scores)[:5])}
    assert got == want
    n = scored.count()
    print("scored", n, "of", matches)
    assert n < matches / 2
    same = search.full_text(q, t, 5, index=search.postings(t))
    assert {(r.query_id, r.id): (r["rank"], round(r.score, 9)) for r in same.collect()} == want


def test_hubs_are_cut_before_the_shuffle(spark):
    """The first edges of a query are picked on each task before its edges meet in one."""
    from loremill.operators import graph

    edges = spark.createDataFrame([("T", "hub", f"n{k:03}", 1.0, "") for k in range(300)], "type string, source string, target string, confidence double, description string").repartition(4)
    seeds = spark.createDataFrame([(1, 1, "hub")], "query_id long, rank int, id string")
    rels, ends = graph.neighbourhood(edges, seeds)
    assert rels.count() == 30 and ends.count() == 20
    plan = rels._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_matches_are_not_written(spark, monkeypatch):
    """Many queries for words that all texts have: no written table has a row for each match."""
    rows = []

    def counted(df, small=False):
        out = cut(df, small)
        rows.append(out.count())
        return out

    cut = search.cut
    monkeypatch.setattr(search, "cut", counted)
    texts = [(i, f"alpha beta {'alpha ' * (i % 7)} w{i}") for i in range(400)]
    queries = [(q, ["alpha", "Beta", "beta alpha", f"alpha w{q}"][q % 4]) for q in range(60)]
    t, q = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(queries, "query_id long, query string")
    got = {(r.query_id, r["rank"]): r.id for r in search.full_text(q, t, 3).collect()}
    assert max(rows) <= 400, rows
    assert [got[0, k] for k in (1, 2, 3)] == [6, 13, 20] and [got[1, k] for k in (1, 2, 3)] == [0, 1, 2]
    assert all(got[a + 4, k] == got[a, k] for a in range(0, 56) if a % 4 < 3 for k in (1, 2, 3))
    assert all(got[a, 1] == a for a in range(3, 60, 4)) and len(got) == 3 * 45 + 15
