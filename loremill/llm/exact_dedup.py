"""Exact dedup by deterministic block naming, with DataFrame operations only.

A text is cut into blocks of a fixed number of characters. Equal blocks get one integer name: the
distinct blocks are sorted and numbered. Adjacent names are then paired, the distinct pairs sorted
and numbered again, and so on until every text has a single name. Two texts have the same name
exactly when they are equal; no hash decides equality.

Only text that can have a twin is sorted: a block whose fingerprint occurs once in the corpus equals
no other block, so the text that holds it equals no other text and keeps its own identity. That
decision is exact (different fingerprints mean different blocks) and moves 8 bytes a block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import cut

BLOCK_CHARS = 4096


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Integer names for distinct rows, in sorted order; written, so that each name is given once."""
    return cut(distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Rows are equal when their texts are; of equal rows the largest id stays. Null text counts as the
    empty text; all empty texts are one group. A row that is repeated under one id counts each time in
    ``group_size``, and each repeat of the row that stays is marked kept. A null id is the smallest.
    Other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("sha", F.sha2("text", 256))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.char_length("text") / F.lit(block_chars))).cast("int")
    blocks = rows.select(
        "id", "sha", n_blocks.alias("n"),
        F.posexplode(F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda i: F.substring(F.col("text"), i * block_chars + 1, F.lit(block_chars)))).alias("at", "block"),
    )

    prints = blocks.select("id", "sha", "n", "at", F.xxhash64("block").alias("print"))
    repeated = cut(prints.groupBy("print").agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1").select("print"))
    whole = (
        prints.join(repeated, "print", "left_semi")
        .groupBy("id", "sha", "n")
        .agg(F.count(F.lit(1)).alias("found"), F.sum((F.col("at") == 0).cast("long")).alias("rows"))
        .filter("found = n * rows")
        .select("id", "sha", "rows")
    )
    whole = cut(whole)

    same_row = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["sha"] == b["sha"])
    # A merge join at every size: the rows with a twin grow with the corpus, so they are never sent to all executors.
    twins = cut(blocks.join(whole.hint("merge"), same_row(blocks, whole), "left_semi").dropDuplicates(["id", "sha", "at"]))
    named = twins.join(_numbered(twins.select("block").distinct(), "block"), "block").select("id", "sha", "at", "name")
    longest = twins.agg(F.max("n")).first()[0] or 1
    for _ in range((longest - 1).bit_length()):
        half = lambda k: F.max(F.when(F.col("at") % 2 == k, F.col("name")))
        pairs = cut(named.groupBy("id", "sha", F.shiftright("at", 1).alias("at")).agg(half(0).alias("left"), half(1).alias("right")))
        names = _numbered(pairs.select("left", "right").distinct(), "left", "right")
        named = pairs.join(names, pairs["left"].eqNullSafe(names["left"]) & pairs["right"].eqNullSafe(names["right"])).select("id", "sha", "at", "name")
    named = named.drop("at")
    named = cut(named.join(whole, same_row(named, whole)).select(named["id"], named["sha"], "name", "rows"))

    groups = cut(named.groupBy("name").agg(F.max("id").alias("keep_id"), F.sum("rows").alias("group_size")).filter("group_size > 1"))
    grouped = named.join(groups, "name").select("id", "sha", "keep_id", "group_size")
    out = rows.select("id", "sha").join(grouped, same_row(rows, grouped), "left")
    keep = F.when(grouped["group_size"].isNull(), rows["id"]).otherwise(grouped["keep_id"])
    return out.select(
        rows["id"].alias(id_col),
        keep.alias("keep_id"),
        F.coalesce(grouped["group_size"], F.lit(1)).alias("group_size"),
        rows["id"].eqNullSafe(keep).alias("kept"),
        rows["sha"].alias("text_sha256"),
    )


ORACLE = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, sha256(coalesce(text, '')) AS text_sha256
      FROM documents WINDOW g AS (PARTITION BY coalesce(text, '')))
"""
