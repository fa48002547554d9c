"""Cases of the review's fourth round."""

from __future__ import annotations

import random

import pytest

from loremill.llm import passages
from tests.llm.test_llm_operators import frame, prose


def with_changes(rng, own, n):
    gone = set(rng.sample(range(len(own)), n))
    return [w + "x" if k in gone else w for k, w in enumerate(own)]


def fragments(rng, cuts):
    """Earlier documents have pieces of a passage, each too short to count; one has all of it, and a later one a copy with changed words."""
    texts, want = [], set()
    for _ in range(40):
        own = prose(rng, 60)
        texts += [prose(rng, 50) + own[a:b] + prose(rng, 50) for a, b in cuts]
        want.add((len(texts) + 1, len(texts)))
        texts += [prose(rng, 50) + p + prose(rng, 50) for p in (own, with_changes(rng, own, 7))]
    return texts, want


def scattered(rng):
    """The first document has the pieces of all passages, each elsewhere."""
    every = [prose(rng, 60) for _ in range(40)]
    pieces = [own[a : a + 20] for own in every for a in (0, 20, 40)]
    rng.shuffle(pieces)
    texts, want = [[w for p in pieces for w in p + prose(rng, 30)]], set()
    for own in every:
        want.add((len(texts) + 1, len(texts)))
        texts += [prose(rng, 50) + p + prose(rng, 50) for p in (own, with_changes(rng, own, 7))]
    return texts, want


@pytest.mark.parametrize("case", ["pieces", "overlapping", "scattered"])
def test_inexact_passages_of_several_first_documents(spark, case):
    rng = random.Random(41)
    texts, want = scattered(rng) if case == "scattered" else fragments(rng, [(0, 20), (20, 40), (40, 60), *([(10, 30), (30, 50)] if case == "overlapping" else [])])
    found = {(r.doc_id, r.source_id) for r in passages.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()}
    assert len(found & want) >= 0.9 * len(want)


def test_inexact_passages_of_common_sentences(spark):
    """Texts of a few sentences in any order: two of them in a row stand in more documents than are looked at, so three seeds tell where a passage comes from."""
    rng = random.Random(42)
    pool = [prose(rng, 12) for _ in range(12)]
    docs = [[w for _ in range(12) for w in rng.choice(pool)] for _ in range(250)]
    copies = [with_changes(rng, d[a : a + 60], 7) for d in rng.sample(docs[50:], 60) for a in [rng.randrange(84)]]
    texts = [*docs, *(prose(rng, 40) + c + prose(rng, 40) for c in copies)]
    got = {}
    for r in passages.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect():
        got.setdefault(r.doc_id, set()).update(range(r.from_word, r.to_word))
        x, y = texts[r.doc_id][r.from_word : r.to_word], texts[r.source_id][r.source_from : r.source_to]
        assert r.source_id < r.doc_id and r.to_word - r.from_word == r.n_words >= 50 and len(set(x) & set(y)) >= 0.5 * len(set(x))
    assert sum(len(got.get(k, set()) & set(range(40, 100))) >= 50 for k in range(250, 310)) >= 0.9 * 60


def test_pipeline_takes_inexact_passages_out(spark):
    """The substring stage cuts copies of passages whose seeds have several first documents."""
    import corpus_pipeline

    texts, want = fragments(random.Random(43), [(0, 20), (20, 40), (40, 60)])
    left = {r.doc_id: len(r.text.split()) for r in corpus_pipeline.substring_stage(spark, frame(spark, [" ".join(t) for t in texts]), "").collect()}
    assert len(left) == len(texts) and sum(left[d] <= 112 for d, _ in want) >= 0.9 * len(want)
    assert all(left[e] == 160 for _, e in want)
