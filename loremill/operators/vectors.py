"""Exact nearest vectors by cosine, with cells that most queries need not look into.

Vectors are dealt to the nearest of some centres; a cell knows its radius, the greatest angle between its centre
and one of its vectors. Angles obey the triangle inequality, so no vector of a cell is nearer to a query than the
angle to its centre less its radius. A query looks into the nearest cells first; the score of its last place then
says which of the other cells could hold something better, and only these are scored.

Queries and vectors meet in joins, by cell and in blocks of bounded size: neither side is sent to all tasks or to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import cut

#: Vectors that centres are fitted on at most (and their bytes), and rounds of fitting. The driver holds these and the centres, no more.
SAMPLE, SAMPLE_BYTES, FITS = 8192, 32 << 20, 8
#: Vectors for a centre, and centres at most; cells that every query looks into.
PER_CELL, MOST_CELLS, PROBES = 256, 1024, 3
#: Vectors and queries of a cell that are scored together.
VECTORS, QUERIES = 4096, 1024
#: Vectors whose angles to all centres are held at once: a matrix of at most 1,024 x 1,024 and its copies.
SLICE = 1024
#: What an angle may be off by from rounding.
SLACK = 1e-6


@dataclass
class Cells:
    """``own``: ``scope, cell, block, id, unit``; ``sizes``: ``scope, cell, radius, n, blocks``, a row for each cell of a scope."""

    centres: np.ndarray
    own: DataFrame
    sizes: DataFrame


def _unit(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have a direction, and these with length 1."""
    if not len(vectors):
        return np.zeros(0, bool), np.zeros((0, 1))
    m = np.stack(vectors.to_numpy()).astype(np.float64)
    length = np.linalg.norm(m, axis=1)
    return length > 0, m[length > 0] / length[length > 0][:, None]


def _fitted(sample: np.ndarray, k: int) -> np.ndarray:
    centres = sample[:k].copy()
    for _ in range(FITS if k < len(sample) else 0):
        own = (sample @ centres.T).argmax(axis=1)
        for c in range(k):
            total = sample[own == c].sum(axis=0)
            length = np.linalg.norm(total)
            if length > 0:
                centres[c] = total / length
    return centres


def _sliced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches in parts of SLICE rows, so that angles to many centres take no more room than to few."""
    for frame in frames:
        for at in range(0, len(frame), SLICE):
            yield frame.iloc[at : at + SLICE].reset_index(drop=True)


def _angles(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(m @ centres.T, -1, 1))


def cells(vectors: DataFrame, k: int | None = None) -> Cells:
    """Every vector (``id, scope, vector``) in its cell. Null and zero vectors are left out.

    Centres are fitted on the SAMPLE vectors whose ids have the least hashes, no more than SAMPLE_BYTES of them; they decide
    how much is pruned, never what is found.
    """
    given = vectors.filter("vector IS NOT NULL").select("id", "scope", "vector")
    kind = dict(given.dtypes)["id"]
    shape = given.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    some = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * (shape["width"] or 1))))
    k = k or max(1, min(MOST_CELLS, (shape["n"] or 0) // PER_CELL))
    sample = given.orderBy(F.xxhash64("id"), "id").limit(some).select("vector").toPandas() if k > 1 else pd.DataFrame({"vector": []})
    _, units = _unit(sample["vector"])
    centres = _fitted(units, min(k, len(units))) if len(units) else np.zeros((1, shape["width"] or 1))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _sliced(frames):
            keep, m = _unit(frame["vector"])
            if keep.any():
                angle = _angles(m, centres)
                cell = angle.argmin(axis=1)
                yield pd.DataFrame({"id": frame["id"][keep], "scope": frame["scope"][keep], "cell": cell.astype(np.int32), "angle": angle[np.arange(len(m)), cell], "unit": list(m)})

    dealt = cut(given.mapInPandas(assign, f"id {kind}, scope {dict(given.dtypes)['scope']}, cell int, angle double, unit array<double>"))
    sizes = dealt.groupBy("scope", "cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n"))
    sizes = cut(sizes.withColumn("blocks", F.ceil(F.col("n") / F.lit(VECTORS)).cast("int")))
    blocks = sizes.select(F.col("scope").alias("s"), F.col("cell").alias("c"), "blocks")
    placed = dealt.join(blocks, dealt["scope"].eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    own = cut(placed.select("scope", "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "unit"))
    return Cells(centres, own, sizes)


def _visits(queries: DataFrame, index: Cells, first: bool) -> DataFrame:
    """``query_id, unit, scope, cell, blocks``: the cells that queries look into, at first or (with ``edge``, the score to reach) after that."""
    centres, probes = index.centres, min(PROBES, len(index.centres))
    widest = np.zeros(len(centres))
    for r in index.sizes.groupBy("cell").agg(F.max("radius").alias("radius")).collect():  # at most MOST_CELLS rows
        widest[r["cell"]] = r["radius"]
    kinds = dict(queries.dtypes)

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _sliced(frames):
            keep, m = _unit(frame["vector"])
            if not keep.any():
                continue
            frame, angle = frame[keep], _angles(m, centres)
            order = np.argsort(angle, axis=1, kind="stable")
            near = np.zeros_like(angle, dtype=bool)
            np.put_along_axis(near, order[:, :probes], True, axis=1)
            if first:
                q, c = np.nonzero(near)
                edge = np.full(len(frame), -2.0)
            else:
                edge = frame["edge"].fillna(-2.0).to_numpy()
                reach = np.cos(np.maximum(0, angle - widest[None, :] - SLACK))
                q, c = np.nonzero(~near & (reach >= edge[:, None] - SLACK))
            # A query at a time, so that its vector is not copied for all of them at once.
            for at in range(0, len(q), 4096):
                qq, cc = q[at : at + 4096], c[at : at + 4096]
                yield pd.DataFrame({"query_id": frame["query_id"].to_numpy()[qq], "asked": frame["scope"].to_numpy()[qq], "unit": list(m[qq]), "at": cc.astype(np.int32), "away": angle[qq, cc], "edge": edge[qq]})

    seen = queries.mapInPandas(look, f"query_id {kinds['query_id']}, asked {kinds['scope']}, unit array<double>, at int, away double, edge double")
    size = index.sizes
    one = seen.filter("asked IS NOT NULL").join(size, (F.col("asked") == F.col("scope")) & (F.col("at") == F.col("cell")))
    every = seen.filter("asked IS NULL").join(size, F.col("at") == F.col("cell"))
    could = F.cos(F.greatest(F.lit(0.0), F.col("away") - F.col("radius") - SLACK)) >= F.col("edge") - SLACK
    return cut(one.unionByName(every).filter(could).select("query_id", "unit", "scope", "cell", "n", "blocks"))


def _scored(visits: DataFrame, index: Cells, limit: int) -> DataFrame:
    """``query_id, id, score``: of each block of vectors the best for each query that looks into it."""
    key = F.to_json(F.struct("scope", "cell"))
    asks = visits.select(key.alias("key"), "query_id", F.col("unit").alias("ask"), "blocks")
    wide = cut(asks.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).cast("int").alias("wide"), F.first("blocks").alias("blocks")))
    asks = asks.drop("blocks").join(wide, "key").withColumn("deal", F.pmod(F.xxhash64("query_id"), F.col("wide")).cast("int"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", "block", "deal", "query_id", "ask")
    own = index.own.withColumn("key", key).join(wide.select("key", "wide"), "key").withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("wide") - 1))).select("key", "block", "deal", "id", "unit")

    def score(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": asked["query_id"][:0], "id": held["id"][:0], "score": pd.Series(dtype=float)})
        found = np.stack(asked["ask"].to_numpy()) @ np.stack(held["unit"].to_numpy()).T
        k = min(limit, found.shape[1])
        edge = np.partition(found, -k, axis=1)[:, -k]
        q, i = np.nonzero(found >= edge[:, None] - 1e-8)  # the order is by nine places and id, see ``ranked``
        return pd.DataFrame({"query_id": asked["query_id"].to_numpy()[q], "id": held["id"].to_numpy()[i], "score": found[q, i]})

    kinds = f"query_id {dict(asks.dtypes)['query_id']}, id {dict(own.dtypes)['id']}, score double"
    return asks.groupBy("key", "block", "deal").cogroup(own.groupBy("key", "block", "deal")).applyInPandas(score, kinds)


def ranked(hits: DataFrame, limit: int) -> DataFrame:
    """``rank`` from 1 by score, then id; scores are compared to nine places, so the order does not hang on the last bit."""
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def nearest(queries: DataFrame, index: Cells, limit: int) -> tuple[DataFrame, DataFrame]:
    """The nearest vectors, ``query_id, id, score, rank``, and what was looked into, ``query_id, scope, cell, n``.

    ``queries``: ``query_id, scope, vector``; a query with a scope finds vectors of that scope only. Null and zero queries find nothing.
    """
    asked = queries.filter("vector IS NOT NULL").select("query_id", "scope", "vector")
    looked = _visits(asked, index, first=True)
    best = cut(ranked(_scored(looked, index, limit), limit))
    if len(index.centres) > PROBES:
        edge = best.filter(F.col("rank") == limit).select(F.col("query_id").alias("of"), F.col("score").alias("edge"))
        more = _visits(asked.join(edge, F.col("query_id") == F.col("of"), "left").drop("of"), index, first=False)
        best = ranked(best.drop("rank").unionByName(_scored(more, index, limit)), limit)
        looked = looked.unionByName(more)
    return best, looked.select("query_id", "scope", "cell", "n")
