"""The trie of rebuilt conversations against a dictionary of prefixes; contraction on any forest."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loremill.llm import prefix_trie as T

CONV = "conv_id long, turn long, role string, text string"


def expected(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own.setdefault(c, []).append((t is not None, t or 0, r, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), x))
    own = {c: [(m[2], m[4]) for m in sorted(ms)] for c, ms in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    whole = {c: own.get(c - c % 5, [])[: h[c]] + ms[h[c] :] for c, ms in own.items()}
    members, ends = {}, {}
    for c, ms in whole.items():
        for d in range(len(ms) + 1):
            members.setdefault(tuple(ms[:d]), []).append(c)
        ends.setdefault(tuple(ms), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)

    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path in members:
        own_saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += own_saved
    return sorted(
        (min(ms), len(path), -1 if not path else min(members[path[:-1]]), len(ms), len(kids.get(path, [])), leaves[path], saved[path], hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest())
        for path, ms in members.items()
    )


def result(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize("per_part, pieces", [(256, 4096), (9, 2)])
def test_by_definition(spark, monkeypatch, per_part, pieces):
    monkeypatch.setattr(T, "IDS_PER_PIECE", pieces)
    rng = random.Random(per_part)
    rows = []
    for c in [*range(60), None]:
        if c in (10, 25):
            continue  # first of their five: not there
        same = rng.random() < 0.4
        for k in range(rng.randint(1, 30 if c in (20, 21) else 11)):
            rows.append((c, rng.choice([None, 3]) if k == 2 else k, rng.choice(["user", "assistant", None]) if not same else "user", rng.choice(["hi", "é", None, "yes"]) if not same else "one"))
    df = spark.createDataFrame(rows, CONV).withColumn("depth", F.lit("z")).withColumn("conv", F.lit(1)).repartition(3)
    assert result(T.prefix_trie(df, per_part)) == expected(rows)


def test_a_conversation_with_most_rows(spark):
    """Twins of 120 turns are one unary chain of shared nodes, with all other conversations beside it; parts of 16 turns."""
    rows = [(c, k, "user", f"t{k}") for c in (5, 1005) for k in range(120)] + [(c, 0, "user", "x") for c in range(2000, 2008)]
    assert result(T.prefix_trie(spark.createDataFrame(rows, CONV), 16)) == expected(rows)


def test_contraction_of_any_forest(spark):
    rng = random.Random(1)
    parents = {0: None, 1: None}
    for v in range(2, 160):
        parents[v] = v - 1 if rng.random() < 0.6 else rng.randrange(v)
    values = {v: (rng.randint(-5, 9), 1) for v in parents}
    want = {v: list(x) for v, x in values.items()}
    for v in sorted(parents, reverse=True):
        if parents[v] is not None:
            want[parents[v]] = [a + b for a, b in zip(want[parents[v]], want[v])]
    df = spark.createDataFrame([(v, p, *values[v]) for v, p in parents.items()], "id long, parent long, x long, n long")
    assert {r.id: [r.x, r.n] for r in T.subtree_totals(df, ["x", "n"]).collect()} == want


def test_odd(spark):
    assert T.prefix_trie(spark.createDataFrame([], CONV)).count() == 0
    assert T.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], CONV)).count() == 0
    rows = [(3, None, None, None), (3, None, None, None), (3, 1, "user", "x" * 100_000)]
    assert result(T.prefix_trie(spark.createDataFrame(rows, CONV))) == expected(rows)
