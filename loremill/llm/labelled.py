"""Labelled rows for the classifiers: folds by id, a bounded training sample, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)), F.lit(0))


def _usable(labels: DataFrame, label: str, parts: int, held_out: int) -> DataFrame:
    own = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", parts) != held_out))
    return own.groupBy("doc_id").agg(F.min(label).alias("label"))


def class_counts(labels: DataFrame, label: str, parts: int, held_out: int) -> tuple[int, int]:
    """Labelled documents of class 0 and 1 outside the held-out fold: two numbers, for the classes' true shares."""
    found = {r["label"]: r["n"] for r in _usable(labels, label, parts, held_out).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return found.get(0, 0), found.get(1, 0)


def shares(label: np.ndarray, counts: tuple[int, int] | None) -> np.ndarray | None:
    """Weights that give the classes of a sample the shares they have among all labelled documents."""
    if counts is None or not all(counts):
        return None
    own = [max(int((label == y).sum()), 1) for y in (0, 1)]
    return np.where(label == 1, counts[1] / own[1], counts[0] / own[0]) * len(label) / sum(counts)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, held_out: int, each: int, chars: int) -> DataFrame:
    """``doc_id, text, label``: whole labelled documents, none from the held-out fold: at most ``each`` of each class, and no more after they have ``chars`` characters together.

    The documents drawn are those whose ids have the least hashes, so the sample is the same however the
    tables are split; texts of any length are drawn, and of each class one at least. A document that the
    labels name twice, or contradict themselves on, is left out of neither: its first label in order
    counts. Labels of documents that are not there are passed over.
    """
    text = docs.select("doc_id", F.coalesce(docs["text"], F.lit("")).alias("text"))
    own = _usable(labels, label, parts, held_out)
    sized = text.select("doc_id", F.length("text").alias("size")).join(own, "doc_id").groupBy("doc_id", "label").agg(F.sum("size").alias("size"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = [sized.filter(F.col("label") == y).orderBy(*order).limit(each) for y in (0, 1)]
    # At most 2 * each rows of fixed size from here on: what is summed up in order, and the side that is sent to all executors.
    before = F.coalesce(F.sum("size").over(Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = drawn[0].unionByName(drawn[1]).withColumn("before", before).filter((F.col("before") == 0) | (F.col("before") + F.col("size") <= chars))
    return text.join(F.broadcast(chosen.select("doc_id", F.col("label").cast("int").alias("label"))), "doc_id").select("doc_id", "text", "label")


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the labels, by Newton's method with a little regularisation."""
    x = np.column_stack([margin, np.ones_like(margin)])
    w = np.zeros(2)
    weight = np.ones_like(margin) if weight is None else weight
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (p - label)) + 1e-3 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])
