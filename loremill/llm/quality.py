"""Quality by a linear-chain conditional random field over lines.

Each line of a document is good or bad. The field sees features of the line and of the lines before and
after it, and has weights between the labels of neighbouring lines. The forward-backward algorithm gives
each line's marginal probability of being good; their mean, weighted by length, is the document's
quality, and a logistic curve fitted to the labelled documents makes it a score.

Features are counts of byte classes, found for all lines of a batch at once, so a text of any length
is scored whole at a few passes over its bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import calibrate, class_counts, fold, shares, sigmoid, training_rows
from .shared import text_slices
from .words import span_hashes

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
#: The training sample: documents of each class, and the characters after which no more are drawn.
TRAIN_EACH, TRAIN_CHARS = 1000, 8_000_000
SLICE_BYTES = 400_000

LOWER, UPPER, DIGIT, SPACE, STOP, PUNCT, SYMBOL, OTHER = range(8)


def _classes() -> np.ndarray:
    kind = np.full(256, SYMBOL, dtype=np.uint8)
    for chars, k in ((b"abcdefghijklmnopqrstuvwxyz", LOWER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER), (b"0123456789", DIGIT), (b" \t\r\n\x0b\x0c", SPACE), (b".?", STOP), (b",;:'\"()-", PUNCT)):
        kind[list(chars)] = k
    kind[128:] = OTHER
    return kind


CLASS_OF = _classes()
N_OWN = 20
N_FEATURES = 3 * N_OWN + 3  # own, before, after; first, last, constant


def line_features(docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines (by row), lengths of the lines in bytes, and where each document's lines begin (one more at the end).

    A document has at least one line, the empty one.
    """
    lines = [t.split("\n") for t in docs]
    counts = np.array([len(x) for x in lines])
    starts = np.concatenate([[0], np.cumsum(counts)])
    raw = np.frombuffer("\n".join(docs).encode() + b"\n", np.uint8)
    n = int(starts[-1])
    ends = np.flatnonzero(raw == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    size = ends - begins
    kind = CLASS_OF[raw]
    row = np.repeat(np.arange(n), size + 1)
    tally = np.bincount(row * 8 + kind, minlength=8 * n).reshape(n, 8).astype(np.float64)
    tally[:, SPACE] -= 1  # the line end
    same = np.zeros(len(raw), dtype=bool)
    same[1:] = (raw[1:] == raw[:-1]) & ((kind[1:] == SYMBOL) | (kind[1:] == PUNCT))
    runs = np.add.reduceat(same, begins, dtype=np.float64)
    word = np.zeros(len(raw), dtype=bool)
    word[1:] = (kind[1:] != SPACE) & (kind[:-1] == SPACE)
    word[0] = kind[0] != SPACE
    words = np.add.reduceat(word, begins, dtype=np.float64)
    # Words that repeat the word before them, or the one before that.
    first = np.flatnonzero(word)
    past = np.flatnonzero((kind == SPACE)[1:] & (kind != SPACE)[:-1]) + 1
    name, line = span_hashes(raw, first, past), row[first]
    twice = np.zeros((2, n))
    for k in (1, 2):
        hit = (name[k:] == name[:-k]) & (line[k:] == line[:-k])
        twice[k - 1] = np.bincount(line[k:][hit], minlength=n)
    again = np.zeros(n)
    for k, own in enumerate(lines):
        if len(own) > 1:
            seen = Counter(own)
            if len(seen) < len(own):
                again[starts[k] : starts[k + 1]] = [seen[x] > 1 and x != "" for x in own]

    long = np.maximum(size, 1)
    share = tally / long[:, None]
    letters = np.maximum(tally[:, LOWER] + tally[:, UPPER], 1)
    per_word = tally[:, SYMBOL] / np.maximum(words, 1)
    own = np.column_stack(
        [
            np.log1p(size) / 8, size == 0, words <= 2, share[:, UPPER], share[:, DIGIT], share[:, SYMBOL], share[:, PUNCT], share[:, OTHER],
            tally[:, UPPER] / letters, tally[:, UPPER] / letters > 0.5, np.minimum(per_word, 4) / 4, share[:, SYMBOL] > 0.05,
            np.minimum(runs / np.maximum(words, 1), 4) / 4, tally[:, STOP] / np.maximum(words, 1), np.minimum(long / np.maximum(words, 1), 20) / 20,
            again, np.minimum(4 * twice[0] / np.maximum(words, 1), 1), np.minimum(4 * twice[1] / np.maximum(words, 1), 1), np.minimum(tally[:, SYMBOL], 20) / 20, (words > 12) & (tally[:, STOP] == 0),
        ]
    ).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    first, last = np.zeros(n, np.float32), np.zeros(n, np.float32)
    first[starts[:-1]] = last[starts[1:] - 1] = 1
    before[starts[:-1]] = after[starts[1:] - 1] = 0
    return np.column_stack([own, before, after, first, last, np.ones(n, np.float32)]), size.astype(np.float64), starts


@dataclass
class LineField:
    """Weights of the good label against the bad one, of label pairs (from, to), and the curve of the score."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def messages(self, lead: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of good from the lines up to each line, and from those after it.

        With two labels a message is one number; all documents of a batch step together, longest first.
        """
        t = self.pairs
        size = np.diff(starts)
        order = np.argsort(-size, kind="stable")
        begin, size = starts[:-1][order], size[order]
        forward, backward = np.empty_like(lead), np.zeros_like(lead)
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")  # documents with more than k lines
        for k in range(longest):
            at = begin[: active[k]] + k
            if k:
                r = forward[at - 1]
                forward[at] = lead[at] + np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])
            else:
                forward[at] = lead[at]
        for k in range(longest - 2, -1, -1):
            at = begin[: active[k + 1]] + k
            r = backward[at + 1] + lead[at + 1]
            backward[at] = np.logaddexp(r + t[1, 1], t[1, 0]) - np.logaddexp(r + t[0, 1], t[0, 0])
        return forward, backward

    def marginals(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        forward, backward = self.messages(features.astype(np.float64) @ self.weights, starts)
        return sigmoid(forward + backward)

    def quality(self, features: np.ndarray, size: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mean probability of good by document, weighted by length (an empty line counts as one byte)."""
        weight = np.maximum(size, 1)
        p = self.marginals(features, starts)
        return np.add.reduceat(p * weight, starts[:-1]) / np.add.reduceat(weight, starts[:-1])

    def score(self, docs: list[str]) -> np.ndarray:
        q = self.quality(*line_features(docs))
        return sigmoid(self.slope * _odds(q) + self.offset)


def _odds(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def _train(features: np.ndarray, starts: np.ndarray, target: np.ndarray, steps: int, penalty: float = 1e-3) -> LineField:
    """Maximum likelihood by Adam: expected less given counts of features and label pairs."""
    f = features  # single precision: the sample's features are what the driver holds
    inner = np.ones(len(f), dtype=bool)
    inner[starts[1:] - 1] = False
    at = np.flatnonzero(inner)
    given = np.array([[np.mean((target[at] == a) & (target[at + 1] == b)) if len(at) else 0.0 for b in (0, 1)] for a in (0, 1)])
    field = LineField(np.zeros(f.shape[1]), np.zeros((2, 2)))
    theta, m, v = np.zeros(f.shape[1] + 4), 0.0, 0.0
    for k in range(1, steps + 1):
        field.weights, field.pairs = theta[:-4], theta[-4:].reshape(2, 2)
        lead = (f @ field.weights.astype(np.float32)).astype(np.float64)
        forward, backward = field.messages(lead, starts)
        g = (f.T @ (sigmoid(forward + backward) - target).astype(np.float32)).astype(np.float64) / len(f) + penalty * field.weights
        expected = np.zeros((2, 2))
        if len(at):
            after = lead[at + 1] + backward[at + 1]
            joint = np.stack([field.pairs[a, b] + a * forward[at] + b * after for a in (0, 1) for b in (0, 1)])
            joint = np.exp(joint - np.logaddexp.reduce(joint, axis=0))
            expected = joint.mean(axis=1).reshape(2, 2)
        g = np.concatenate([g, (expected - given).ravel() + penalty * field.pairs.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    field.weights, field.pairs = theta[:-4].copy(), theta[-4:].reshape(2, 2).copy()
    return field


def _sample_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line_features`` of a sample, some documents at a time, so that only the features are held."""
    parts = [line_features(texts[k : k + 50]) for k in range(0, len(texts), 50)]
    offset = np.cumsum([0, *(p[2][-1] for p in parts)])
    starts = np.concatenate([p[2][:-1] + o for p, o in zip(parts, offset)] + [offset[-1:]])
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), starts


def fit(texts: list[str], labels: list[int], counts: tuple[int, int] | None = None, steps: int = 80) -> LineField | None:
    """A field from labelled documents; None if a class has none.

    Lines start with their document's label. Lines of bad documents that look good to a first field keep
    the label good in the second, but for the worst line of each bad document.
    """
    y = np.array(labels, dtype=np.float64)
    if not (y == 0).any() or not (y == 1).any():
        return None
    features, size, starts = _sample_features(texts)
    target = np.repeat(y, np.diff(starts))
    balance = _train(features, starts, target, steps // 2)
    own = (features @ balance.weights.astype(np.float32)).astype(np.float64)
    worst = np.minimum.reduceat(own, starts[:-1])
    target = np.where((target == 0) & (own > 2) & (own > np.repeat(worst, np.diff(starts))), 1.0, target)
    field = _train(features, starts, target, steps)
    field.slope, field.offset = calibrate(_odds(field.quality(features, size, starts)), y, shares(y, counts))
    return field


def score_documents(docs: DataFrame, field: LineField | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score``: one row per input row. Null text is empty, and an empty text has one empty line. Without a field every score is 0.5. Other columns are no inputs."""
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for begin, part in text_slices(b.column(1), SLICE_BYTES):
                score = np.full(len(part), 0.5) if field is None else field.score(part)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, len(part)), pa.array(score, pa.float64())], ["id", "score"])

    return source.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def likely_good(docs: DataFrame, field: LineField | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, unchanged; all of them without a field."""
    if field is None:
        return docs

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([field.score(part) for _, part in text_slices(text, SLICE_BYTES)] or [np.zeros(0)]), pa.float64())

    return docs.filter(score(F.col(text_col)) >= least)


def fit_from(docs: DataFrame, labels: DataFrame) -> LineField | None:
    rows = training_rows(docs, labels, "quality", FOLDS, HELD_OUT, TRAIN_EACH, TRAIN_CHARS).toPandas().sort_values(["doc_id", "text"])
    return fit(rows["text"].tolist(), rows["label"].tolist(), class_counts(labels, "quality", FOLDS, HELD_OUT))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per document, repeated rows each; empty tables give an empty result."""
    scored = score_documents(docs, fit_from(docs, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
