"""A read-through cache in front of costly functions: hits are joined in, only misses are worked out, results are kept by fingerprint."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.utils import AnalysisException

from .components import cut


def cached(wanted: DataFrame, path: str, key: list[str], output_schema: str, run: Callable[[DataFrame], DataFrame], force: bool = False) -> DataFrame:
    """``wanted`` with ``result`` and ``hit`` (whether it was there before).

    ``wanted`` has the key columns, ``chunks_sha256`` (see ``lifecycle.fingerprints``) and whatever ``run`` needs;
    ``run`` gives ``key, chunks_sha256, result`` for the rows it gets, which are the misses, or all when forced. A
    result counts for its key, fingerprint and output schema; a changed input or schema is a miss.

    Misses are written before results are read back, so ``run`` works on each once however often the outcome is used. A run's
    results stand in a folder of their own, which is there as a whole or not at all, so lost tasks write
    nothing twice, and a second run finds them. A forced run's results are newer; the newest counts.
    """
    spark, by = wanted.sparkSession, [*key, "chunks_sha256"]
    wanted = cut(wanted)
    before = _held(spark, path, key, output_schema)
    if before is None or force:
        misses = wanted.drop_duplicates(by)
    else:
        misses = wanted.drop_duplicates(by).join(before.select(*by), by, "left_anti")
    misses = cut(misses)
    if not misses.isEmpty():
        made = 0 if before is None else before.agg(F.max("made")).first()[0] or 0
        fresh = run(misses).select(*by, "result").withColumn("output_schema", F.lit(output_schema)).withColumn("made", F.lit(made + 1).cast("long"))
        fresh.write.parquet(f"{path}/run={uuid.uuid4().hex}")
    found = _held(spark, path, key, output_schema)
    known = misses.select(*by).withColumn("hit", F.lit(False))
    return wanted.join(found.select(*by, "result"), by, "left").join(known, by, "left").withColumn("hit", F.coalesce("hit", F.col("result").isNotNull())) if found is not None else wanted.withColumn("result", F.lit(None).cast("string")).withColumn("hit", F.lit(False))


def _held(spark, path: str, key: list[str], output_schema: str) -> DataFrame | None:
    """The newest result for each key and fingerprint under a schema; two runs at one time may both have written one."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        return None
    own = rows.filter(F.col("output_schema") == output_schema)
    newest = F.row_number().over(Window.partitionBy(*key, "chunks_sha256").orderBy(F.desc("made"), "run"))  # as many rows as runs
    return own.withColumn("_n", newest).filter("_n = 1").drop("_n", "run")
