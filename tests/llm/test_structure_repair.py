"""Repair of dialogues against all edits by brute force, in parts of any length, and on odd rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loremill.llm import structure_repair as R

CONV = "conv_id long, turn long, role string, text string"


def right(initials: str) -> bool:
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(body) > 0 and body == "ua" * (len(body) // 2))


def expected(rows):
    """By definition: the least (cost, letters) of every sequence of edits with at most one more insertion than is ever needed."""
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
    faults, seen = [], set()
    for _, _, r, x in rows:
        core = x.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not core else "d" if (r, x) in seen else "t" if core[-1] not in ".!?" else "-")
        seen.add((r, x))
    best = None

    def grow(k, cost, audit, out, since):
        nonlocal best
        if cost > (best[0] if best else 4 * len(rows)):
            return
        if k == len(rows) and right("".join(r[:1] or "?" for r, _ in out)):
            best = min(best or (cost, audit, out), (cost, audit, out))
        if since < 1:  # two in a row are never worth it; test_prices_are_distances allows any number
            for role in ("user", "assistant"):
                grow(k, cost + 3, audit + "I", out + [(role, "")], since + 1)
        if k < len(rows):
            _, _, r, x = rows[k]
            more = 3 if faults[k] == "t" else 0
            if faults[k] in "t-":
                grow(k + 1, cost + more, audit + "K", out + [(r, x)], 0)
                for role in ("user", "assistant"):
                    grow(k + 1, cost + 3 + more, audit + "R", out + [(role, x)], 0)
            grow(k + 1, cost + 4, audit + "D", out, 0)

    grow(0, 0, "", [], 0)
    initials = [r[:1] for _, _, r, _ in rows]
    turns = [t for some, t, _, _ in rows if some]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        faults.count("b"), faults.count("d"), faults.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        best[0], best[1], hashlib.sha256("\n".join(f"{r}:{x}" for r, x in best[2]).encode()).hexdigest(),
    )


def result(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


@pytest.mark.parametrize("per_part", [128, 3, 1])
def test_all_edits(spark, per_part):
    rng = random.Random(5)
    convs = {c: [(rng.choice([None, 0, 1, 1, 2, 5, 9]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "umpire"]), rng.choice(["a.", "b!", "c", "", " \n", "d? ", None, "é…", "f. "])) for _ in range(rng.randint(1, 4))] for c in [*range(60), None]}
    rows = [(c, *m) for c, ms in convs.items() for m in ms]
    got = {r.conv_id: result(r) for r in R.repair(spark.createDataFrame(rows, CONV).repartition(3), per_part).collect()}
    assert len(got) == len(convs)
    for c, ms in convs.items():
        assert got[c] == expected(ms), (c, ms)


def test_parts_are_one_dialogue(spark):
    """A dialogue that holds most rows gives the same in parts of 7 as in one part, with a message repeated throughout."""
    rng = random.Random(8)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"n{k}.", f"n{k}", ""])) for k in range(100)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, CONV)
    one, many = ({r.conv_id: result(r) for r in R.repair(df, n).collect()} for n in (1000, 7))
    assert one == many and one[2][6] == "KK"


def test_prices_are_distances():
    """After the auction every node of a shortest path has its distance as its price, by Bellman's equations."""
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 12)
        lattice = R.Lattice("".join(rng.choice("sua.") for _ in range(n)), "".join(rng.choice("---btd") for _ in range(n)), (R.START, R.ASSISTANT), True)
        far = [R.FAR] * len(lattice.arcs)
        far[lattice.goal] = 0
        for _ in range(4 * n + 8):
            for v, out in enumerate(lattice.arcs):
                for _, cost, to, _ in out:
                    far[v] = min(far[v], cost + far[to])
        assert lattice.auction(R.START) == far[R.START]
        assert all(p <= d for p, d in zip(lattice.price, far))
        node = R.START
        for letter, k, _ in lattice.follow(R.START):
            assert lattice.price[node] == far[node]
            node = next(to for s, _, to, _ in lattice.arcs[node] if s == letter)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(3)] + [(None, None, None, None), (7, None, "user", None)]
    import zlib

    want = []
    for c, t, r, x in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r if r is not None else " ", x if x is not None else " "
        x = {1: "", 2: x.replace(".", "").replace("!", "").replace("?", "")}.get(fate, x)
        want += [(c, t, "user" if fate == 4 else r, x)] * {0: 0, 3: 2}.get(fate, 1)
    got = [tuple(r) for r in R.damaged(spark.createDataFrame(rows, CONV)).collect()]
    key = lambda r: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    all_ids = R.repair_damaged(spark.createDataFrame(rows, CONV)).collect()
    assert {r.conv_id for r in all_ids} == {r[0] for r in rows} and len(all_ids) == 41


def test_odd(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi."), (1, 1, "assistant", "x" * 300_000 + ".")], CONV).withColumn("audit", F.lit(1)).withColumn("conv", F.lit("c")).withColumn("m", F.lit(2))
    r = R.repair(df).first()
    assert (r.audit, r.cost, r.truncated) == ("KK", 0, 0)
    assert R.repair(df.limit(0)).count() == 0 and R.repair_damaged(df.limit(0)).count() == 0
    # A dialogue of which the damage leaves nothing.
    gone = [c for c in range(400) if __import__("zlib").crc32(f"{c}:0".encode()) % 20 == 0][:2]
    got = R.repair_damaged(spark.createDataFrame([(c, 0, "user", "hi.") for c in gone], CONV)).collect()
    assert [result(r) for r in got] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())] * 2
