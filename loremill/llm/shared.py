"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.components import cut, discard, shared_dir

__all__ = ["cut", "discard", "numbered", "shared_dir", "table", "text_slices"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (the path may be one that only Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(column: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about ``most`` bytes, one row at least; null is empty. So a worker never holds a whole batch of texts as Python strings."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield at, [t or "" for t in column.slice(at, end - at).to_pylist()]
        at = end


def numbered(rows: DataFrame, per_part: int) -> DataFrame:
    """``conv, part, m``: the rows of each ``conv`` in the order of their other columns, ``per_part`` to an array of structs.

    Rows that are equal in all columns may change places: they are the same. A key with more rows than a part
    is sorted by range over all tasks, so not even one that holds a third of all rows meets in one task.
    """
    order = [c for c in rows.columns if c != "conv"]
    whole = F.sort_array(F.collect_list(F.struct(*order))).alias("m")
    long = cut(rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > per_part).select(F.col("conv").alias("big")))
    if long.isEmpty():
        return rows.groupBy("conv").agg(whole).select("conv", F.lit(0).cast("long").alias("part"), "m")
    same = rows["conv"].eqNullSafe(long["big"])
    short = rows.join(long, same, "left_anti").groupBy("conv").agg(whole)
    keys = ["conv", *order, "tie"]
    rest = rows.join(long, same, "left_semi").withColumn("tie", F.monotonically_increasing_id())
    placed = cut(rest.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id()).drop("tie"))
    split = F.shiftrightunsigned("place", 33)
    spans = placed.groupBy("conv", split.alias("split")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("k"))
    earlier = Window.partitionBy("conv").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition that the key is in
    spans = cut(spans.select(F.col("conv").alias("c"), "split", "first", F.coalesce(F.sum("k").over(earlier), F.lit(0)).alias("before")))
    ranked = placed.join(spans, placed["conv"].eqNullSafe(spans["c"]) & (split == spans["split"]))
    part = F.floor((F.col("place") - F.col("first") + F.col("before")) / F.lit(per_part)).cast("long")
    parts = ranked.select("conv", part.alias("part"), "place", *order).groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("place", *order))).alias("m"))
    parts = parts.select("conv", "part", F.transform("m", lambda x: F.struct(*[x[c].alias(c) for c in order])).alias("m"))
    return short.select("conv", F.lit(0).cast("long").alias("part"), "m").unionByName(parts)
