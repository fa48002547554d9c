"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words; a shorter one is a single window. A window is
the set of its shingles (runs of SHINGLE words, all of it if it is shorter), and occurs in a document only
if all of them do, one after the other. So:

1. Documents are read once. Words and shingles are hashed, and a shingle that no item has is dropped by a
   table of bits, whose size is bounded whatever the benchmark's. A window of w words needs w - SHINGLE + 1
   shingles in a row (the bound on length): only stretches with so many are written, with their words.
2. Shingles are ordered by rarity, as counted in the documents' stretches. For exact containment the necessary
   prefix of a window is its rarest shingle alone, and a window with a shingle that no document has is out.
3. Prefixes are joined with the stretches' shingles. The place of a shingle in its window bounds where the
   window begins and ends (the bound on position), and what is left is verified word by word.

Nothing but the table of bits is sent to all tasks, no pairs of documents or of items are made, and a passage
that a third of all documents hold is a key of a join whose other side has a row for each window that it is rarest in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import cut, text_slices
from .words import span_hashes

WINDOW, SHINGLE = 10, 4
#: Bits for each shingle of the benchmark, and at most so many in all (16 MB); with more shingles than that the table lets more through, and later steps sort it out.
BITS_EACH, MOST_BITS = 64, 1 << 27
#: Bytes of text that a task works on at a time.
SLICE = 1 << 21
#: Fixed: what stands between words, once A-Z are small letters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words_of(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), F.lit(WORD), F.lit(0))


def _word_places(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in small letters, first byte and end of each word, and where each text's words begin (one more at the end)."""
    coded = [t.encode() for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)]
    inside = _IN_WORD[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate([[0], change])
    begin, end = change[::2], change[1::2]
    edge = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])]).astype(np.int64)
    return data, begin, end, np.searchsorted(begin, edge)


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    at = np.arange(max(0, len(words) - k + 1))
    return span_hashes(words, at, at + k)


def _window_prints(text: pd.Series) -> pd.Series:
    """The shingles of each window (its words with a blank between), in order."""
    data, begin, end, starts = _word_places(list(text))
    words = span_hashes(data, begin, end)
    own = [words[a:b] for a, b in zip(starts[:-1], starts[1:])]
    return pd.Series([_shingles(w, min(len(w), SHINGLE)).view(np.int64).tolist() for w in own])


SCANNED = "n_words long, stretches array<struct<start int, words array<string>, at array<int>, print array<long>>>"
_STRETCH = pa.struct([("start", pa.int32()), ("words", pa.list_(pa.string())), ("at", pa.list_(pa.int32())), ("print", pa.list_(pa.int64()))])


def _scan(needs: dict[int, int], bits: np.ndarray):
    """Counts the words of each text and finds its stretches. ``needs``: for each size of shingle how many in a row the shortest window has."""
    mask = np.uint64(len(bits) * 64 - 1)

    def known(prints: np.ndarray) -> np.ndarray:
        at = prints & mask
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def one(texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
        data, begin, end, starts = _word_places(texts)
        words = span_hashes(data, begin, end)
        n = len(words)
        ends = np.repeat(starts[1:], np.diff(starts))
        cover, tokens = np.zeros(n + 1, np.int64), []
        for k, need in needs.items():
            prints = _shingles(words, k)
            hit = known(prints) & (np.arange(len(prints)) + k <= ends[: len(prints)])
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            first, after = edges[::2], edges[1::2]
            long = after - first >= need
            first, after = first[long], after[long]
            np.add.at(cover, first, 1)
            np.add.at(cover, after + k - 1, -1)
            at = np.repeat(first - np.concatenate([[0], np.cumsum(after - first)[:-1]]), after - first) + np.arange((after - first).sum()) if len(first) else np.zeros(0, np.int64)
            tokens.append((at, prints[at]))
        found: list[list[dict]] = [[] for _ in texts]
        inside = np.cumsum(cover)[:n] > 0
        edge = np.zeros(n + 1, dtype=bool)
        edge[starts] = True
        begins = np.flatnonzero(inside & (edge[:n] | ~np.concatenate([[False], inside[:-1]]))) if n else np.zeros(0, np.int64)
        stops = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1 if n else begins
        if len(begins):
            at, prints = np.concatenate([t[0] for t in tokens]), np.concatenate([t[1] for t in tokens])
            order = np.argsort(at, kind="stable")
            at, prints = at[order], prints[order].view(np.int64)
            text_of = np.searchsorted(starts, begins, side="right") - 1
            low, high = np.searchsorted(at, begins), np.searchsorted(at, stops)
            raw = data.tobytes()
            for x, a, b, i, j in zip(text_of, begins, stops, low, high):
                own = [raw[s:e].decode() for s, e in zip(begin[a:b].tolist(), end[a:b].tolist())]
                found[x].append({"start": int(a - starts[x]), "words": own, "at": (at[i:j] - a).tolist(), "print": prints[i:j].tolist()})
        return np.diff(starts), found

    def run(column: pa.Array) -> pa.Array:
        counts, found = [np.zeros(0, np.int64)], []
        for _, texts in text_slices(column, SLICE):
            n, own = one(texts)
            counts.append(n)
            found += own
        return pa.StructArray.from_arrays([pa.array(np.concatenate(counts), pa.int64()), pa.array(found, pa.list_(_STRETCH))], ["n_words", "stretches"])

    return run


def _bits(prints: DataFrame) -> np.ndarray:
    """A table of bits with one for each value of ``print``; at most MOST_BITS, so at most a fixed number of rows reach the driver."""
    n = prints.agg(F.approx_count_distinct("print").alias("n")).first()["n"]
    size = 1 << 16
    while size < n * BITS_EACH and size < MOST_BITS:
        size *= 2
    at = F.col("print").bitwiseAND(F.lit(size - 1))
    rows = prints.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST((print & {size - 1}) & 63 AS INT))")).alias("bits")).toPandas()
    table = np.zeros(size // 64, np.uint64)
    table[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return table


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, spans array<struct<start, end>>, item_ids array<string>``.

    ``spans`` are the maximal runs of words (from ``start`` up to ``end``, which is not in it) that stand in an occurrence
    of some item's window, ``item_ids`` the items with an occurring window, as strings in order. Words are runs of
    digits, letters and characters beyond ASCII; A-Z count as small. A null text has no words and an item without words
    no window. Rows are taken one by one, so repeated and null ids stay; an item without id marks words but is not listed, and items of one
    id are one. Other columns are ignored; an empty table of documents gives no rows, one of items no spans.
    """
    own = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w"))
    cuts = F.when(F.size("w") > window, F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))), lambda i: F.slice("w", i + 1, window))).when(F.size("w") > 0, F.array("w"))
    held = cut(own.select("item", F.explode(cuts).alias("words")).distinct())
    joined = F.array_join("words", " ")
    windows = cut(held.select("words").distinct().withColumn("prints", F.pandas_udf(_window_prints, "array<long>")(joined)).withColumn("window", F.monotonically_increasing_id()))
    shapes = [r["n"] for r in windows.select(F.size("words").alias("n")).distinct().collect()]  # at most ``window`` of them
    needs = {k: min(n - k + 1 for n in shapes if min(n, SHINGLE) == k) for k in sorted({min(n, SHINGLE) for n in shapes})}
    prints = windows.select("window", F.posexplode("prints").alias("offset", "print"))

    scan = F.arrow_udf(_scan(needs, _bits(prints)), SCANNED)
    scanned = docs.select(F.col(doc_id).alias("doc_id"), scan(F.col(text)).alias("x"))
    scanned = cut(scanned.select("doc_id", "x.n_words", "x.stretches").withColumn("row", F.monotonically_increasing_id()))
    stretches = scanned.select("row", F.explode("stretches").alias("s")).select("row", "s.start", "s.words", "s.at", "s.print")
    tokens = stretches.select("row", "start", F.size("words").alias("length"), F.explode(F.arrays_zip("at", "print")).alias("t")).select("row", "start", "length", "t.at", "t.print")

    counts = tokens.groupBy("print").agg(F.count(F.lit(1)).alias("uses"))
    rarest = prints.join(counts, "print").groupBy("window").agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("uses", "print", "offset")).alias("first"))
    prefix = cut(windows.join(rarest, "window").filter(F.col("present") == F.size("prints")).select("window", "words", F.col("first.print").alias("print"), F.col("first.offset").alias("offset")))
    begins = F.col("at") - F.col("offset")
    fits = (begins >= 0) & (begins + F.size("words") <= F.col("length"))
    asked = tokens.join(prefix, "print").filter(fits).groupBy("row", "start").agg(F.collect_list(F.struct(begins.alias("begin"), "window", F.col("words").alias("want"))).alias("asked"))

    there = F.filter("asked", lambda a: F.slice(F.col("words"), a["begin"] + 1, F.size(a["want"])) == a["want"])
    spots = F.sort_array(F.transform(there, lambda a: F.struct(a["begin"].alias("begin"), (a["begin"] + F.size(a["want"])).alias("end"), a["window"].alias("window"))))
    found = cut(stretches.join(asked, ["row", "start"]).select("row", "start", spots.alias("spots")).filter(F.size("spots") > 0))
    merged = F.aggregate(
        "spots",
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.col("start") + s["begin"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], (F.col("start") + s["end"]).cast("long")).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct((F.col("start") + s["begin"]).cast("long").alias("start"), (F.col("start") + s["end"]).cast("long").alias("end"))))),
    )
    spans = found.select("row", merged.alias("spans")).groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    names = windows.select("window", "words").join(held, "words").select("window", "item")
    listed = found.select("row", F.explode(F.array_distinct("spots.window")).alias("window")).distinct().join(names, "window").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    out = scanned.select("row", "doc_id", "n_words").join(spans.join(listed, "row", "left"), "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("spans", F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")).alias("spans"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def with_digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


_CUT_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"

ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_CUT_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_CUT_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, w[i + 1 : i + least(len(w), {WINDOW})] AS win FROM (SELECT item, w, unnest(range(greatest(len(w) - {WINDOW}, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT r, i, n, w[i + 1 : i + n] AS win FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM d JOIN sizes ON len(w) >= n)),
hit AS MATERIALIZED (SELECT r, i, n, item FROM dw JOIN bw USING (win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
