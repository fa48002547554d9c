"""Best-fit packing by bin completion.

Every document becomes one or more pieces of at most ``capacity`` tokens. Only the number of pieces of
each length matters for packing, and there are at most ``capacity`` lengths whatever the size of the
corpus. So the search runs on that histogram: fill one sequence around the longest piece that is left,
and use the same filling as often as the histogram allows. Spark then deals the pieces of each length
out to the places that the fillings have for it, in parallel and without sorting more than a salted
share of a length at a time.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import WordCache, chunks, library, texts
from .shared import cut

CAPACITY, END_ID = 2048, 0
#: Shares in which the pieces of one length are ranked; steps of the search, the only bound on it.
SALTS, SEARCH_STEPS = 256, 200_000


# ---- the search over lengths ----------------------------------------------------------------------


@dataclass
class Filling:
    """A sequence of pieces, longest first, used ``times`` times."""

    lengths: list[int]
    times: int


class Budget:
    """Steps that are left to a search; None: as many as it takes."""

    def __init__(self, steps: int | None) -> None:
        self.steps = math.inf if steps is None else steps

    def __bool__(self) -> bool:
        return self.steps > 0


@dataclass
class _Node:
    left: np.ndarray  # pieces left of each length
    bins: int
    waste: int
    fillings: tuple  # linked: (earlier, Filling)
    ways: Iterator[Filling]


def _sums(lengths: np.ndarray, capacity: int) -> list[int]:
    """For each length the sums that it and lesser ones can have, in any number, as bits; a bound on what pieces can fill."""
    out, bits, every = [], 1, (1 << capacity + 1) - 1
    for x in lengths.tolist():
        step = x
        while step <= capacity:
            bits |= bits << step & every
            step *= 2
        out.append(bits)
    return out


def _exactly(have: list[int], left: np.ndarray, sums: list[int], target: int, budget: Budget) -> Iterator[list[int]]:
    """Pieces that add up to ``target``, longest first, from the longest first piece down."""

    def grow(target: int, top: int, taken: list[int], used: int) -> Iterator[list[int]]:
        # used: how many of the last length in ``taken`` are in it
        if not target:
            yield list(taken)
            return
        k = min(top, bisect.bisect_right(have, target) - 1)
        while k >= 0 and sums[k] >> target & 1 and budget:
            budget.steps -= 1
            x = have[k]
            again = used if taken and taken[-1] == x else 0
            if left[x] > again:
                taken.append(x)
                yield from grow(target - x, k, taken, again + 1)
                taken.pop()
            k -= 1

    return grow(target, len(have) - 1, [], 0)


def _dominated(filling: list[int], spare: int, left: np.ndarray) -> bool:
    """Could one piece that is left stand for a piece of the filling, or for two of them, without taking more than the spare room?

    What such a piece leaves over is easier to place, so a filling that allows it is not needed.
    """
    one = Counter(filling)
    parts = {x: x + 1 for x in one} | {x + y: x + y for x, y in itertools.combinations_with_replacement(one, 2) if x != y or one[x] > 1}
    return any((left[low : total + spare + 1] > [one.get(x, 0) for x in range(low, min(total + spare + 1, len(left)))]).any() for total, low in parts.items())


def _fillings(left: np.ndarray, capacity: int, most_waste: int, sums: tuple[list[int], list[int]], budget: Budget) -> Iterator[Filling]:
    """Undominated sequences around the longest piece, fullest first, each as often as the pieces allow and then once.

    After a sequence that is used once the same may be used again, so any number of times between is a branch as well.

    ``most_waste``: what may be left empty; ``sums``: lengths and what they add up to (see ``_sums``).
    """
    longest = int(np.flatnonzero(left)[-1])
    rest = left.copy()
    rest[longest] -= 1
    have, reach = sums
    found = [k for k, x in enumerate(have) if rest[x]]
    own, bits = [have[k] for k in found], [reach[k] for k in found]
    gap = capacity - longest
    for spare in range(min(gap, most_waste) + 1):
        budget.steps -= 1
        if not budget:
            return
        for filling in _exactly(own, rest, bits, gap - spare, budget) if spare < gap else [[]]:
            budget.steps -= 1
            if _dominated(filling, spare, rest) or not filling and own and own[0] <= gap:
                continue
            lengths = [longest, *filling]
            times = min(int(left[x]) // n for x, n in Counter(lengths).items())
            yield Filling(lengths, times)
            if times > 1:
                yield Filling(lengths, 1)


def _best_fit(left: np.ndarray, capacity: int) -> tuple[int, tuple]:
    """Longest first, each gap filled by the longest piece that fits: bins and linked fillings."""
    left, bins, fillings = left.copy(), 0, ()
    while len(have := np.flatnonzero(left)):
        lengths, gap = [int(have[-1])], capacity - int(have[-1])
        used = {lengths[0]: 1}
        while gap and len(fit := have[have <= gap]):
            k = len(fit) - 1
            while k >= 0 and left[fit[k]] <= used.get(int(fit[k]), 0):
                k -= 1
            if k < 0:
                break
            x = int(fit[k])
            lengths.append(x)
            used[x] = used.get(x, 0) + 1
            gap -= x
        times = min(int(left[x]) // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * times
        bins, fillings = bins + times, (fillings, Filling(lengths, times))
    return bins, fillings


def _linked(fillings: tuple) -> list[Filling]:
    out = []
    while fillings:
        fillings, last = fillings
        out.append(last)
    return out[::-1]


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, steps: int | None = SEARCH_STEPS) -> list[Filling]:
    """Fillings that use up all pieces in few sequences.

    ``counts``: pieces of each length from 1 to ``capacity``. Depth-first branch-and-bound: a sequence is
    completed around the longest piece that is left by each undominated filling, of any number of pieces;
    a branch ends when what it has wasted leaves no way below the incumbent. The incumbent is at first
    the best-fit solution; branches are closed by best-fit, at depths that double, and each better solution
    becomes the incumbent. The search ends when the incumbent meets the volume bound, when every branch
    has been tried, or after ``steps`` steps; with None for these it ends with a proof, however long that takes.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    total = int((left * np.arange(capacity + 1)).sum())
    bound = -(-total // capacity)
    best, fillings = _best_fit(left, capacity)
    have = np.flatnonzero(left)
    sums, budget = (have.tolist(), _sums(have, capacity)), Budget(steps)
    spare = lambda waste: (best - 1) * capacity - total - waste
    stack = [_Node(left, 0, 0, (), _fillings(left, capacity, spare(0), sums, budget))] if best > bound else []
    while stack and best > bound and budget:
        node = stack[-1]
        way = next(node.ways, None)
        if way is None:
            stack.pop()
            continue
        waste = node.waste + way.times * (capacity - sum(way.lengths))
        if spare(waste) < 0:
            continue
        after = node.left.copy()
        for x, n in Counter(way.lengths).items():
            after[x] -= n * way.times
        bins, ways = node.bins + way.times, (node.fillings, way)
        depth = len(stack)
        if not after.any() or depth & (depth - 1) == 0:
            more, rest = _best_fit(after, capacity)
            if bins + more < best:
                best, fillings = bins + more, ways
                for f in _linked(rest):
                    fillings = (fillings, f)
        if after.any():
            stack.append(_Node(after, bins, waste, ways, _fillings(after, capacity, spare(waste), sums, budget)))
    return _linked(fillings)


# ---- pieces -----------------------------------------------------------------------------------------


@functools.lru_cache(maxsize=4)
def _words(path: str) -> WordCache:
    """Ids of normalised words by the tokenizers library, kept in a cache of bounded size. One for each Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, normalizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.normalizer = normalizers.Sequence([])  # a word is normalised once, with its text

    def ids(word: str) -> bytes:
        if len(word) > 1 and word[-1] in ".,;:!?" and word[-2].isalnum() and word[-2] < "\u0300":
            return cache[word[:-1]] + cache[word[-1]]
        return np.array(tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    cache = WordCache(ids)
    return cache


def token_ids(text: str, path: str) -> bytes:
    """The ids as little-endian unsigned 32-bit integers. The tokenizer never looks across white space, so words are looked up one by one."""
    if "<|" in text:  # the special tokens' strings are looked for before anything else
        return np.array(library(path).encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    return b"".join(map(_words(path).__getitem__, chunks(text, path)))


def document_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, piece, start, length, ids_crc32``: the pieces of each document's ids with id 0 after the last."""
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, piece, length, crc = [], [], [], []
            for k, text in enumerate(texts(b.column(1))):
                raw = token_ids(text, path) + END_ID.to_bytes(4, "little")
                for at in range(0, len(raw), 4 * capacity):
                    own = raw[at : at + 4 * capacity]
                    row.append(k)
                    piece.append(at // (4 * capacity))
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            piece = np.array(piece, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int32())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("id", id_col)


# ---- places -----------------------------------------------------------------------------------------


def _places(fillings: list[Filling]) -> pd.DataFrame:
    """Where the pieces of each length go: from rank ``first`` on, ``each`` to a sequence, from sequence ``base`` on, at ``offset``."""
    rows, used, base = [], {}, 0
    for f in fillings:
        offset = 0
        for length in sorted(set(f.lengths), reverse=True):
            each = f.lengths.count(length)
            first = used.get(length, 0)
            rows.append((length, first, each, base, offset))
            used[length] = first + each * f.times
            offset += each * length
        base += f.times
    return pd.DataFrame(rows, columns=["length", "first", "each", "base", "offset"]).astype("int64").sort_values(["length", "first"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", steps: int | None = SEARCH_STEPS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` has ``id_col, piece, length`` and is read more than once, so it should be a written table.

    What reaches the driver is a count for each of at most ``capacity`` lengths; what it sends out are the
    places of the fillings, a few for each length. Ties and repeated rows each get a place of their own.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(complete_bins(counts, capacity, steps))
    key, stride = places["length"].to_numpy(), 1 << 44
    sorted_first = key * stride + places["first"].to_numpy()

    salt = F.pmod(F.xxhash64(id_col, "piece"), F.lit(SALTS)).cast("int")
    salted = pieces.withColumn("salt", salt)
    shares = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rest = [c for c in pieces.columns if c not in (id_col, "piece")]
    within = Window.partitionBy("length", "salt").orderBy(id_col, "piece", *[c for c in rest if c != "length"])
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(shares, ["length", "salt"])

    # 44 bits of rank: the key of a length and rank is one integer.
    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(sorted_first, length.to_numpy() * stride + rank.to_numpy(), side="right") - 1
        own = places.iloc[at]
        k = rank.to_numpy() - own["first"].to_numpy()
        each = own["each"].to_numpy()
        return pd.DataFrame({"sequence_id": own["base"].to_numpy() + k // each, "offset": own["offset"].to_numpy() + k % each * length.to_numpy()})

    put = ranked.withColumn("put", place(F.col("length"), (F.col("before") + F.col("rank")).cast("long")))
    return put.select(*pieces.columns, "put.sequence_id", "put.offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", steps: int | None = SEARCH_STEPS) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    Null text is empty; an empty document is one piece with the end id alone. Documents of more than
    ``capacity`` ids are cut, others stay whole. Other columns are ignored, also ones that carry the
    result's names; an empty table gives an empty result. ``steps`` bounds the search (see ``complete_bins``).
    """
    return pack(cut(document_pieces(docs, path, capacity, id_col, text_col)), capacity, id_col, steps)
