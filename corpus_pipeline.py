"""From raw documents to packed training sequences: five stages, each of which can be written and read again.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of ``documents``;
each works on all that its predecessor kept. Rows with a null id pass the near-duplicate and substring
stages as they are, since decisions there are by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loremill.llm import bag_minhash, exact_dedup, packing, passages, quality
from loremill.llm.registry import word_bpe
from loremill.llm.shared import cut, table

#: A document goes when it is likelier bad than good.
LEAST_QUALITY = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field does not reject. It learns from the labels of the training folds."""
    return quality.likely_good(docs, quality.fit_from(docs, table(spark, sf_dir, "labels")), LEAST_QUALITY)


def _whole(docs: DataFrame) -> DataFrame:
    """``doc, id, text``: each document as one column besides its id and text, so that no name of its own is in the way."""
    doc = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return doc.select("doc", F.col("doc.doc_id").alias("id"), F.coalesce("doc.text", F.lit("")).alias("text"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; of rows repeated under one id, one."""
    kept = cut(exact_dedup.exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).distinct())
    own = _whole(docs).withColumn("sha", F.sha2("text", 256)).drop("text")
    named = own.join(kept.hint("merge"), ["id", "sha"], "left_semi").dropDuplicates(["id", "sha"])
    unnamed = own.filter("id IS NULL").join(kept.filter("id IS NULL").hint("merge"), "sha", "left_semi").dropDuplicates(["sha"])
    return named.select("doc.*").unionByName(unnamed.select("doc.*"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least id."""
    kept = cut(bag_minhash.near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text_hash").distinct())
    own = _whole(docs).withColumn("text_hash", F.xxhash64("text")).drop("text")
    named = own.join(kept.hint("merge"), ["id", "text_hash"], "left_semi")
    return named.unionByName(own.filter("id IS NULL")).select("doc.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; documents of which nothing is left go."""
    return passages.without_passages(docs, cut(passages.repeated_passages(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, word_bpe())


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier, the signatures and the chains are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
