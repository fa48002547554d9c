"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, bands, and exact multiset overlap.

A document is the multiset of its runs of five words. Think of every unit of weight of every run as a
Poisson process whose points fall on the registers of a signature; a register keeps the earliest point
that falls on it. Two signatures agree in a register with the probability of the weighted Jaccard
similarity of the multisets. To make points for large weights without one process per unit, the weights
are cut at powers of two, an interval has one process with its width as rate, and each of its points is
dealt to a unit by halving the interval again and again (the bits of the point's mark name the halves);
a point counts if its unit is within the weight. Points are made in order of time and only as long as
they can still be a register's earliest.

Bands of registers put similar documents into common buckets. A bucket's members are not compared with
one another, only with its centre, the one that shares the most buckets with others. Links so found lead to
ever more central documents; whom two steps lead to the same one are a group. Where a bucket has members of
several groups, any two of them may be similar. Two
multisets of n and k runs are similar only if their overlap reaches t / (1 + t) (n + k), so when both are
put in one order, rarest runs first, their first common run is among the first of each. So a run among the
first of its multiset calls for comparisons of members of different groups; where one group has most of a
run's members, only the others are compared with them. What all links connect is a class. Compared means that the multisets' overlap is
counted in full. So all that can be missed is a pair that shares no bucket at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.components import components
from .shared import cut, text_slices
from .words import mixed, shingles, word_table

WORDS, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 misses all 16 bands of 4 registers once in 4,500 times.
REGISTERS, BANDS = 64, 16
SLICE_BYTES = 300_000
#: Ratio of the greatest to the least size of a class of sizes.
CLASS = 1.05
_STEP = np.uint64(0xD1B54A32D192ED03)


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def bags(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word runs of each text with their counts, and where each text's begin (one more at the end)."""
    hashes, _, _, starts = word_table(texts)
    runs, first = shingles(hashes, starts, words)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    order = np.lexsort((runs, doc))
    runs, doc = runs[order], doc[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(len(runs), 1), bool), (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.append(new, len(runs)))
    return runs[new], count, np.searchsorted(doc[new], np.arange(len(texts) + 1))


def signatures(elements: np.ndarray, counts: np.ndarray, starts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """A row of registers for each multiset; an empty one has zeros."""
    n = len(starts) - 1
    best = np.full((n, registers), np.inf)
    # One process for each element and interval (0, 1], (1, 2], (2, 4], ... that its weight reaches into.
    doc = np.repeat(np.arange(n), np.diff(starts))
    level = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    at = np.repeat(np.arange(len(elements)), level)
    step = np.arange(len(at)) - np.repeat(np.cumsum(level) - level, level)
    base = np.where(step == 0, 0, 1 << np.maximum(step - 1, 0)).astype(np.int64)
    width = np.maximum(base, 1)
    key = mixed(elements[at] + mixed(step.astype(np.uint64) + np.uint64(77)))
    weight, owner = counts[at], doc[at]
    total = np.bincount(doc, counts, minlength=n)
    some = total > 0
    until = np.where(some, (np.log(registers) + 4) / np.maximum(total, 1), 0)
    todo = some.copy()
    while todo.any():
        use = np.flatnonzero(todo[owner])
        time = np.zeros(len(use))
        k = 0
        while len(use):
            with np.errstate(over="ignore"):
                a, b = mixed(key[use] + _STEP * np.uint64(2 * k + 1)), mixed(key[use] + _STEP * np.uint64(2 * k + 2))
            time = time - np.log(_uniform(a)) / (registers * width[use])
            keep = time <= until[owner[use]]
            use, time, b = use[keep], time[keep], b[keep]
            unit = base[use] + ((b >> np.uint64(32)).astype(np.int64) & (width[use] - 1))
            counted = unit < weight[use]
            np.minimum.at(best, (owner[use][counted], (b[counted] % np.uint64(registers)).astype(np.int64)), time[counted])
            k += 1
        todo = some & np.isinf(best).any(axis=1)  # a register had no point in time: look further
        until = until * 2
    return np.where(some[:, None], mixed(best.view(np.uint64)), 0).astype(np.uint64)


def _bands(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.shape[1] // bands
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
    for k in range(rows):
        out = mixed(out + signature[:, k::rows][:, :bands])
    return out


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (sums[starts[1:]] - sums[starts[:-1]]).view(np.int64)


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.view(np.int64)))


def sketch(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """``rows`` (``id, row, text``) as ``id, row, low, high, n, bands``: a 128-bit name of the multiset, its size, and its band hashes (none if it is empty)."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for begin, part in text_slices(b.column(2), SLICE_BYTES):
                elements, counts, starts = bags(part, words)
                n = np.add.reduceat(np.append(counts, 0), np.minimum(starts[:-1], len(counts))) * (np.diff(starts) > 0)
                hashes = _bands(signatures(elements, counts, starts), BANDS)
                some = np.diff(starts) > 0
                first = np.concatenate([[0], np.cumsum(some * BANDS)])
                low, high = _names(elements, counts, starts)
                own = [b.column(k).slice(begin, len(part)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, low, high, pa.array(n, pa.int64()), _lists(hashes[some].ravel(), first)], ["id", "row", "low", "high", "n", "bands"])

    return rows.select("id", "row", "text").mapInArrow(run, f"id {kind}, row long, low long, high long, n long, bands array<long>")


def _names(elements: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Two sums of scrambled elements and counts that name a multiset, whatever the order of its elements."""
    unit = mixed(elements) + counts.astype(np.uint64)
    return pa.array(_sums(mixed(unit), starts)), pa.array(_sums(mixed(unit + _STEP), starts))


def multisets(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """``rows`` (``text``) as ``low, high, runs``: the name of each text's multiset, and its runs. The k-th occurrence of a run is a number of its own, so multisets are compared as sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, part in text_slices(b.column(0), SLICE_BYTES):
                elements, counts, starts = bags(part, words)
                ends = np.concatenate([[0], np.cumsum(counts)])
                again = np.arange(ends[-1]) - np.repeat(ends[:-1], counts)
                low, high = _names(elements, counts, starts)
                yield pa.RecordBatch.from_arrays([low, high, _lists(mixed(np.repeat(elements, counts) + again.astype(np.uint64) * _STEP), ends[starts])], ["low", "high", "runs"])

    return rows.select("text").mapInArrow(run, "low long, high long, runs array<long>")


def overlap(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two multisets given as arrays of numbered runs."""
    common = F.size(F.array_intersect(a, b))
    return common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``id_col, class_id, class_size, n_links, kept, text_hash``.

    Documents whose multisets of five-word runs have a weighted Jaccard similarity of ``similarity`` or
    more are linked; a class is what links connect, named by its least id. The row with the least id stays;
    of rows with that id and different texts the one with the least ``text_hash`` (xxhash64 of the text;
    null counts as empty), which with the id tells rows apart; rows that repeat both are all marked kept.
    ``n_links`` is the number of links between the row's multiset and others that were looked for, a lower bound of all there
    are: members that share a hub or a centre are known to be of one class and not compared with each other. Words ignore
    case and marks. A text of one to four words has one run of them all; texts without words (also null)
    are equal to each other and to nothing else. Rows with equal multisets, repeated rows among them, are
    one class without being compared. A row without id is left as it is, in a class of its own.
    Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))
    named = rows.filter("id IS NOT NULL")
    sketched = cut(sketch(named))
    # Equal multisets are one, and everything from here on is about multisets, known by their names.
    stand = sketched.groupBy("low", "high", "n").agg(F.min(F.struct("id", "row")).alias("first"), F.any_value("bands").alias("bands"))
    stand = cut(stand.select(F.struct("low", "high").alias("rep"), "n", "first", "bands"))
    buckets = stand.select("rep", "n", F.posexplode("bands").alias("band", "hash"))
    shared = cut(buckets.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), small=True)
    members = cut(buckets.join(shared, ["band", "hash"]))
    who = cut(stand.select("rep", "first").join(members.select("rep").distinct().hint("merge"), "rep", "left_semi").select("first.id", "first.row"), small=True)
    sharing = named.join(who.hint("merge"), ["id", "row"], "left_semi").dropDuplicates(["id", "row"])
    runs = cut(multisets(sharing).select(F.struct("low", "high").alias("rep"), "runs"))
    central = _central(members)
    links = cut(_similar(_with_centres(members, central, similarity), runs, similarity), small=True)
    late = _similar(_candidates(members, _hubs(links, central), runs, similarity), runs, similarity)
    links = cut(links.union(late).distinct(), small=True)

    group = cut(components(links).select(F.col("node").alias("rep"), F.col("component").alias("g")), small=True)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    classed = cut(stand.select("rep", "first").join(group.hint("merge"), "rep", "left").join(degree.hint("merge"), "rep", "left").select("rep", "first", F.coalesce("g", "rep").alias("g"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    least = cut(classed.groupBy("g").agg(F.min("first").alias("least")), small=True)
    placed = sketched.select("id", "row", F.struct("low", "high").alias("rep")).join(classed.join(least.hint("merge"), "g").select("rep", "least", "n_links").hint("merge"), "rep")
    placed = cut(placed.select("id", "row", "least", "n_links"))
    sizes = cut(placed.groupBy("least").agg(F.count(F.lit(1)).alias("class_size")), small=True)
    out = placed.join(sizes, "least").select(
        F.col("id").alias(id_col), F.col("least.id").alias("class_id"), "class_size", "n_links", (F.struct("id", "row") == F.col("least")).alias("kept"), F.col("row").alias("text_hash")
    )
    kind = out.schema["class_id"].dataType
    alone = rows.filter("id IS NULL").select(F.col("id").alias(id_col), F.lit(None).cast(kind).alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"), F.col("row").alias("text_hash"))
    return out.unionByName(alone)


def _central(members: DataFrame) -> DataFrame:
    """``rep, s``: how central a multiset is, least first: by the members of all its buckets, then by name."""
    degree = members.groupBy("rep", "n").agg(F.sum("size").alias("d"))
    return cut(degree.select("rep", F.struct((-F.col("d")).alias("d"), F.col("rep").alias("id"), F.col("n").alias("n")).alias("s")), small=True)


def _with_centres(members: DataFrame, central: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: each member of a bucket with the bucket's centre, if their sizes let them be similar."""
    centres = members.select("band", "hash", "rep").join(central, "rep").groupBy("band", "hash").agg(F.min("s").alias("s"))
    pairs = members.join(cut(centres, small=True), ["band", "hash"]).select("rep", "n", F.col("s.id").alias("centre"), F.col("s.n").alias("m")).filter("rep <> centre")
    fits = F.least("n", "m") >= similarity * F.greatest("n", "m")
    return cut(pairs.filter(fits).select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct(), small=True)


def _hubs(links: DataFrame, central: DataFrame) -> DataFrame:
    """``rep, g``: two steps along links, each to the most central neighbour. Who has the same hub is in the same class; most of a class has."""
    ways = links.union(links.select("b", "a")).select(F.col("a").alias("rep"), F.col("b").alias("other"))
    step = ways.join(central.select(F.col("rep").alias("other"), "s"), "other").groupBy("rep").agg(F.min("s").alias("t"))
    step = cut(step.join(central, "rep").select("rep", F.least("s", "t")["id"].alias("to")), small=True)
    return step.join(step.select(F.col("rep").alias("to"), F.col("to").alias("then")), "to").select("rep", F.xxhash64("then").alias("g"))


def _similar(pairs: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """``a, b`` of the pairs whose multisets are similar."""
    side = lambda name, array: runs.select(F.col("rep").alias(name), F.col("runs").alias(array)).hint("merge")
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return both.filter(overlap(F.col("x"), F.col("y")) >= similarity).select("a", "b")


def _candidates(members: DataFrame, hubs: DataFrame, runs: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: which members of buckets with several groups can be similar, of different groups (``hubs``: ``rep, g``; who has none is a group of its own).

    The first (1 - t) n + 1 runs of each, rarest first, are all that is looked at; a run of one member
    only, or of one group only, matches nothing, but keeps its place in the order.
    """
    classed = members.join(hubs.hint("merge"), "rep", "left").select("rep", "n", "band", "hash", F.coalesce("g", F.xxhash64("rep")).alias("g"))
    classed = cut(classed)
    mixed_ = classed.groupBy("band", "hash").agg(F.min("g").alias("g"), F.max("g").alias("h")).filter("g <> h").select("band", "hash")
    open_ = cut(classed.join(cut(mixed_, small=True).hint("merge"), ["band", "hash"], "left_semi").select("rep", "n", "g").distinct())
    each = open_.join(runs.hint("merge"), "rep").select("rep", "n", "g", F.explode("runs").alias("run"))
    often = cut(each.groupBy("run").agg(F.count(F.lit(1)).alias("uses"), F.min("g").alias("g"), F.max("g").alias("h")).filter("uses > 1").select("run", "uses", (F.col("g") != F.col("h")).alias("wide")))
    placed = each.join(often.hint("merge"), "run").groupBy("rep", "n", "g").agg(F.sort_array(F.collect_list(F.struct("uses", "run", "wide"))).alias("order"))  # as many as the document has runs
    start = placed.select("rep", "n", "g", (F.col("n") - F.size("order")).alias("alone"), F.posexplode("order").alias("k", "r")).withColumn("at", F.col("alone") + F.col("k"))
    start = start.filter((F.col("at") <= (1 - similarity) * F.col("n")) & F.col("r.wide")).select("rep", "n", "g", "at", F.col("r.run").alias("run"))
    # Sizes are put into classes: a run is only looked for at places where a partner of the class can be reached at all,
    # so texts of one template, which share runs but not enough of them, do not meet.
    step = math.log(CLASS)
    of = lambda n: F.floor(F.log(n.cast("double")) / step + 1e-9).cast("int")
    start = start.withColumn("own", of(F.col("n"))).withColumn("other", F.explode(F.sequence(of(F.greatest(F.col("n") * similarity, F.lit(1.0))), of(F.col("n") / similarity))))
    smallest = F.greatest(F.ceil(F.exp(F.col("other") * step) * (1 - 1e-9)), F.ceil(F.col("n") * similarity - 1e-9))
    start = start.filter(F.col("at") <= F.col("n") - F.ceil((F.col("n") + smallest) * (similarity / (1 + similarity)) - 1e-9))
    start = cut(start.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")))
    # The group that has most of a run's members is not compared with itself.
    key = ["run", "low", "high"]
    most = start.groupBy(*key, "g").agg(F.count(F.lit(1)).alias("k")).groupBy(*key).agg(F.max(F.struct("k", "g")).alias("most"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    most = cut(most.select(*key, F.col("most.g").alias("most")), small=True)
    side = lambda df, k: df.select(*[F.col(c).alias(f"{c}_{k}") for c in ("run", "own", "other", "rep", "n", "g", "at")])
    few = start.join(most.hint("merge"), key).filter("g <> most").drop("most")
    need = F.ceil((F.col("n_a") + F.col("n_b")) * (similarity / (1 + similarity)) - 1e-9)
    fits = (F.col("g_a") != F.col("g_b")) & (F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
    first = (F.col("at_a") <= F.col("n_a") - need) & (F.col("at_b") <= F.col("n_b") - need)
    x, y = side(cut(few), "a"), side(start, "b").hint("merge")
    met = x.join(y, (F.col("run_a") == F.col("run_b")) & (F.col("own_a") == F.col("other_b")) & (F.col("other_a") == F.col("own_b")) & fits & first)
    return cut(met.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct(), small=True)
