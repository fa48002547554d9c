"""The queries of this subpackage, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bag_minhash, bpe, chat_format, contamination, exact_dedup, packing, passages, prefix_trie, quality, structure_repair, tiff, toxicity, url_filter
from .shared import table


#: The rules that the contract fixes.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op1_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def word_bpe() -> str:
    """The public tokenizer's file; every machine has it at this path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_bpe())


def op4_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op7_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), word_bpe())


def op10_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_media(table(spark, sf_dir, "documents"))


def op9_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.with_digest(chat_format.rotate_perspectives(table(spark, sf_dir, "conversations")))


def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.with_digest(contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op13_tree_contraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_field": op1_line_field,
    "op2_block_naming": op2_block_naming,
    "op3_bin_completion": op3_bin_completion,
    "op4_collinear_chains": op4_collinear_chains,
    "op5_string_kernel": op5_string_kernel,
    "op6_url_ratio": op6_url_ratio,
    "op7_bag_minhash": op7_bag_minhash,
    "op8_backtracking_bpe": op8_backtracking_bpe,
    "op9_perspective_rotation": op9_perspective_rotation,
    "op10_tiff_pages": op10_tiff_pages,
    "op11_auction_repair": op11_auction_repair,
    "op12_prefix_join": op12_prefix_join,
    "op13_tree_contraction": op13_tree_contraction,
}

ORACLE_SQL: dict[str, str] = {
    "op2_block_naming": exact_dedup.ORACLE,
    "op9_perspective_rotation": chat_format.ORACLE,
    "op11_auction_repair": structure_repair.ORACLE,
    "op12_prefix_join": contamination.ORACLE,
    "op13_tree_contraction": prefix_trie.ORACLE,
}
