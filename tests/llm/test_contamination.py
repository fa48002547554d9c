"""Windows of items in documents against the definition, and on odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loremill.llm import contamination as C

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def expected(doc, items, window=10):
    w, hit, names = words(doc), set(), set()
    for item, text in items:
        own = words(text)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            want = own[k : k + window]
            for i in range(len(w) - len(want) + 1):
                if w[i : i + len(want)] == want:
                    hit |= set(range(i, i + len(want)))
                    names |= {str(item)} if item is not None else set()
    return len(w), hit, sorted(names)


@pytest.mark.parametrize("seed, letters, window", [(1, 2, 10), (2, 3, 5), (3, 30, 10), (4, 5, 3)])
def test_by_definition(spark, seed, letters, window):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(["a", "B", "é", "x9", "İ", "ß"][: max(2, letters)] if letters < 9 else [f"w{rng.randint(0, 40)}"]) + rng.choice([" ", "-", "\n", " . "]) for _ in range(n))
    items = [(rng.choice([None, *range(20)]), text(rng.choice([0, 1, 2, 3, 4, 7, 10, 11, 25]))) for _ in range(14)] + [(3, None), (4, " . "), (5, text(40))]
    if letters == 2:
        items = [(i, t) for i, t in items if len(words(t)) > 3 or not words(t)]
    docs = [(k, text(rng.randint(0, 30)) + (rng.choice(items)[1] or "") + " tail " + (rng.choice(items)[1] or "")) for k in range(40)] + [(None, items[-1][1]), (7, None), (8, ""), (8, "x" * 200_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("z")).withColumn("item_id", F.lit(0)).repartition(3)
    got = C.contamination(df, spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit("q")), window).collect()
    assert len(got) == len(docs)
    want = sorted((str(d), *(lambda n, h, i: (n, sorted(h), i))(*expected(t, items, window))) for d, t in docs)
    assert sorted((str(r.doc_id), r.n_words, sorted(x for s in r.spans for x in range(s.start, s.end)), list(r.item_ids)) for r in got) == want
    for r in got:  # spans are maximal
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_full_table_of_bits_changes_nothing(spark, monkeypatch):
    """With a table that lets everything through, the joins and the check of words decide alone."""
    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "three four one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two three four five"), (2, "four one")], "item_id long, text string")
    a = sorted(map(str, C.contamination(docs, items).collect()))
    monkeypatch.setattr(C, "_bits", lambda prints: np.full(1024, ~np.uint64(0)))
    assert sorted(map(str, C.contamination(docs, items).collect())) == a and "start=1, end=5" in a[0]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert C.contamination(docs.limit(0), items).count() == 0
    for none in (items.limit(0), spark.createDataFrame([(1, None), (2, "?!")], "item_id long, text string")):
        assert [(r.n_hit, r.n_items, r.contaminated) for r in C.with_digest(C.contamination(docs, none)).collect()] == [(0, 0, False)] * 2
