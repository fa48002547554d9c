"""Toxicity by a support vector machine with a subsequence string kernel.

Two words are alike as far as they share three letters in the same order, near each other but not
necessarily adjacent: every shared triple counts, less for each character that lies between. The value is
divided by both words' lengths in the space of triples, so a word's value with itself is one, and raised to
a power. So a word stays close to an insult that has gaps or inserted characters; digits and signs that
look like letters count as those, and letters that stand apart with single blanks between are one word.
The kernel of two sentences is the sum over their pairs of words.

Nystroem landmarks make it linear: a sentence's features are its kernel values with a few landmark
words, whitened by the landmarks' own kernel matrix. A linear support vector machine is fitted to the
sentences of labelled documents; since only documents carry labels, the sentences of toxic documents
that it finds clean change sides and it is fitted again. A document is as toxic as its worst sentence; of a
sentence of more than SENTENCE_WORDS words every run of so many counts.

A sentence's margin is a sum over its words, so each Python worker keeps the margins of words it has met
in a cache of bounded size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import calibrate, class_counts, fold, shares, sigmoid, training_rows
from .shared import text_slices
from .words import lowered

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.5
#: The training sample: documents of each class, and the characters after which no more are drawn.
TRAIN_EACH, TRAIN_CHARS = 1500, 5_000_000
#: Letters in a subsequence span at most SPAN characters; each character of the span costs a factor DECAY.
SPAN, DECAY, POWER = 7, 0.7, 4
LETTERS, SENTENCE_WORDS = 64, 40
#: Landmarks, how many of them are benign words, the words they are chosen from, and the kernel values that make two words alike, widely or narrowly.
LANDMARKS, COMMON, CANDIDATES, ALIKE = 64, 16, 150, (0.15, 0.5)
CACHED_WORDS, SLICE_BYTES, BLOCK, LONG = 600_000, 1_000_000, 1024, 50_000

_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a)]
_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
#: Signs that stand for letters.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_APART = re.compile(r"(?<!\S)[\w@$](?:\s[\w@$]){2,}(?!\S)")


def tokens(text: str) -> list[str]:
    """Words in lower case; three or more single characters in a row are one word."""
    text = lowered(text).replace("\0", " ")
    return _APART.sub(lambda m: re.sub(r"\s", "", m[0]), text).split()


_LETTER = np.zeros(128, dtype=np.int64)
_LETTER[97:123] = np.arange(1, 27)
_STANDS = _LETTER.copy()
for _sign, _letter in LOOK_ALIKE.items():
    _STANDS[ord(_sign)] = ord(_letter) - 96


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letter number, word number) of each character of all words: 1 to 26 for a to z, from 27 on shared by other letters, 0 for what is no letter. Signs stand for letters in words that have a letter."""
    raw = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.cumsum(raw == 0) - (raw == 0)
    low = np.minimum(raw, 127)
    letter = np.where(raw < 128, _LETTER[low], np.where(raw >= 192, 27 + raw % 37, 0))
    some = np.bincount(row, letter > 0, minlength=len(words)) > 0
    return np.where((raw < 128) & some[row], _STANDS[low], letter), row


def _triples(code: np.ndarray, row: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, number of the letter triple, weight) of all triples of letters within the span, whose first letter is among the first ``most``."""
    rows, triples, weights = [], [], []
    for a, b in _STEPS:
        n = max(len(code) - a - b, 0)
        n = n if most is None else min(n, most)
        x, y, z = code[:n], code[a : a + n], code[a + b : a + b + n]
        at = np.flatnonzero((x > 0) & (y > 0) & (z > 0) & (row[:n] == row[a + b : a + b + n]))
        rows.append(row[at])
        triples.append((x[at] * LETTERS + y[at]) * LETTERS + z[at])
        weights.append(np.full(len(at), DECAY ** (a + b + 1)))
    return np.concatenate(rows), np.concatenate(triples), np.concatenate(weights)


def _summed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, triple, weight), in order, with the weights of a triple's occurrences in a word added up."""
    row, triple, weight = _triples(*_codes(words))
    key = row * LETTERS**3 + triple
    order = np.argsort(key)
    key, weight = key[order], weight[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))
    return key[first] // LETTERS**3, key[first] % LETTERS**3, np.add.reduceat(weight, first) if len(first) else weight


@dataclass
class Space:
    """Landmarks by the triples that any of them has: a row of ``table`` for each, each landmark at length one; ``where`` has a triple's row, or -1."""

    where: np.ndarray
    table: np.ndarray


def landmark_space(landmarks: list[str]) -> Space:
    row, triple, weight = _summed(landmarks)
    own, at = np.unique(triple, return_inverse=True)
    table = np.zeros((len(own), len(landmarks)))
    table[at, row] = weight
    norm = np.sqrt((table**2).sum(axis=0))
    where = np.full(LETTERS**3, -1, dtype=np.int32)
    where[own] = np.arange(len(own))
    return Space(where, (table / np.where(norm > 0, norm, 1)).astype(np.float32))


def word_kernels(words: list[str], space: Space) -> np.ndarray:
    """Kernel values of each word with each landmark."""
    out = np.zeros((len(words), space.table.shape[1]), dtype=np.float32)
    long = [k for k, w in enumerate(words) if len(w) > LONG]
    short = [k for k, w in enumerate(words) if len(w) <= LONG] if long else None
    for k in long:
        out[k] = _long_word(words[k], space)
    plain = words if short is None else [words[k] for k in short]
    values = np.zeros((len(plain), space.table.shape[1]), dtype=np.float32)
    at = 0
    while at < len(plain):
        end, chars = at, 0
        while end < len(plain) and end - at < BLOCK and (end == at or chars < 2 * LONG):
            chars += len(plain[end])
            end += 1
        row, triple, weight = _summed(plain[at:end])
        norm = np.sqrt(np.bincount(row, weight**2, minlength=end - at))
        place = space.where[triple]
        hit = place >= 0
        row, place, weight = row[hit], place[hit], weight[hit].astype(np.float32)
        if len(row):  # rows come in order
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            values[at + row[first]] = np.add.reduceat(space.table[place] * weight[:, None], first, axis=0) / norm[row[first], None]
        at = end
    if short is None:
        return values**POWER
    out[short] = values**POWER
    return out


def _long_word(word: str, space: Space) -> np.ndarray:
    """The same for a word of any length, a stretch of it at a time."""
    code, row = _codes([word])
    total = np.zeros(LETTERS**3)
    for k in range(0, len(code), LONG):
        _, triple, weight = _triples(code[k : k + LONG + SPAN], row[k : k + LONG + SPAN], LONG)
        total += np.bincount(triple, weight, minlength=len(total))
    norm = np.sqrt((total**2).sum())
    return (total[space.where >= 0] @ space.table[space.where[space.where >= 0]] / (norm or 1)) ** POWER


def _ends(word: str) -> bool:
    return word[-1] in ".!?"


@dataclass
class Machine:
    """Weights of the landmarks' kernel values, the sentence offset and the curve of the document score."""

    landmarks: list[str]
    space: Space
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    cache: dict = field(default_factory=dict, repr=False)
    older: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "cache": {}, "older": {}}

    def _learn(self, words: set[str]) -> None:
        """Margins of new words, with 1j for a word that ends a sentence."""
        if len(self.cache) + len(words) > CACHED_WORDS:
            self.older, self.cache = self.cache, {}
        missing = [w for w in words if w not in self.cache]
        known = [w for w in missing if w in self.older]
        for w in known:
            self.cache[w] = self.older[w]
        missing = [w for w in missing if w not in self.cache]
        margin = word_kernels(missing, self.space) @ self.weights
        for w, m in zip(missing, margin.tolist()):
            self.cache[w] = complex(m, _ends(w))

    def margins(self, texts: list[str]) -> np.ndarray:
        """The highest sentence margin of each text; a text without words has the offset alone."""
        words = [tokens(t) for t in texts]
        new = set().union(*words) - self.cache.keys()
        if new:
            self._learn(new if len(self.cache) + len(new) <= CACHED_WORDS else set().union(*words))
        out = np.full(len(texts), self.bias)
        for k, own in enumerate(words):
            if own:
                value = np.fromiter(map(self.cache.__getitem__, own), dtype=np.complex128, count=len(own))
                margin = value.real.copy()
                margin[1:][value[1:] == value[:-1]] = 0  # a word right after itself counts once
                out[k] = self.bias + worst_sentence(margin, value.imag > 0)
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.slope * self.margins(texts) + self.offset)


def _sentences(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each sentence, and the word after its last."""
    first = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])
    return first, np.append(first[1:], len(ends))


def worst_sentence(margin: np.ndarray, ends: np.ndarray) -> float:
    """The greatest sum over a sentence, or over any SENTENCE_WORDS words in a row of a longer one."""
    first, stop = _sentences(ends)
    total = np.concatenate([[0.0], np.cumsum(margin)])
    size = stop - first
    short = size <= SENTENCE_WORDS
    best = (total[stop[short]] - total[first[short]]).max(initial=-np.inf)
    if not short.all():
        begin = np.arange(len(margin) - SENTENCE_WORDS + 1)
        begin = begin[begin + SENTENCE_WORDS <= np.repeat(stop, size)[begin]]
        best = max(best, (total[begin + SENTENCE_WORDS] - total[begin]).max())
    return float(best)


def training_sentences(ends: np.ndarray) -> list[np.ndarray]:
    """Where sentences begin, longer ones in pieces of SENTENCE_WORDS words; where there are such, once more with the pieces half as far on."""
    first, stop = _sentences(ends)
    out = []
    for shift in (0, SENTENCE_WORDS // 2):
        cuts = [np.arange(a + shift, b, SENTENCE_WORDS) for a, b in zip(first.tolist(), stop.tolist()) if b - a > SENTENCE_WORDS]
        if cuts or not shift:
            out.append(np.unique(np.concatenate([first, *cuts])))
    return out


def _choose(docs: list[set[str]], y: np.ndarray) -> list[str]:
    """Landmarks: words whose families speak for toxic documents; then benign ones.

    Candidates are the words that most toxic documents for each clean one have. A candidate's family is
    every word that the kernel finds alike, so inflected and distorted insults of which each is rare count
    together. Each landmark is the candidate, not alike an earlier one, whose family speaks for the most
    toxic documents against the clean documents it is in; a document counts half after each family it has.
    The benign landmarks are first the words that clean documents have and that are alike a landmark.
    """
    seen = [Counter(w for k, own in enumerate(docs) if y[k] == c for w in own) for c in (0, 1)]
    n = [max(int((y == c).sum()), 1) for c in (0, 1)]
    odds = lambda a, b: np.log((a + 0.5) / (n[1] + 1) * (n[0] + 1) / (b + 0.5))
    gain = {w: a * odds(a, seen[0].get(w, 0)) for w, a in seen[1].items() if len(w) >= 4}
    ranked = sorted((w for w in gain if gain[w] > 0), key=lambda w: (-gain[w], w))[:CANDIDATES]
    chosen: list[str] = []
    contrast: list[str] = []
    if ranked:
        table, words = landmark_space(ranked), sorted({w for own in docs for w in own})
        wide = dict(_near(words, table, ALIKE[0]))
        narrow = dict(_near(list(wide), table, ALIKE[1]))
        toxic, clean, speaks = [], [], []
        for near in (wide, narrow):
            present = np.zeros((len(docs), len(ranked)), dtype=bool)
            for k, own in enumerate(docs):
                for w in own:
                    if w in near:
                        present[k, near[w]] = True
            toxic.append(present[y == 1])
            clean.append(present[y == 0].sum(axis=0))
            speaks.append(odds(toxic[-1].sum(axis=0), clean[-1]))
        open_, free = np.ones(int((y == 1).sum())), np.ones(len(ranked), dtype=bool)
        while len(chosen) < LANDMARKS - COMMON and free.any():
            worth = np.stack([np.where(free & (t.sum(axis=0) >= 2) & (s > 1.5), (open_ @ t) * s, 0) for t, s in zip(toxic, speaks)])
            worth[1, speaks[0] > 1.5] = 0  # the narrow family only where the wide one says nothing
            kind, best = np.unravel_index(int(np.argmax(worth)), worth.shape)
            if worth[kind, best] < 2:
                break
            chosen.append(ranked[best])
            open_ = np.where(toxic[kind][:, best], open_ / 2, open_)
            free[best] = False
            free[(wide, narrow)[kind].get(ranked[best], [])] = False
        # What is alike a landmark and yet speaks for nothing: a benign stem, say.
        at = [ranked.index(w) for w in chosen]
        benign = [w for w, x in narrow.items() if np.isin(at, x).any() and w not in chosen and odds(seen[1].get(w, 0), seen[0].get(w, 0)) < 0.5]
        contrast = sorted(benign, key=lambda w: (-seen[0].get(w, 0), w))[: COMMON * 3 // 4]
    common = [w for w, _ in sorted(seen[0].items(), key=lambda x: (-x[1], x[0])) if len(w) >= 3 and w not in chosen and w not in contrast]
    return chosen + (contrast + common)[:COMMON]


def _near(words: list[str], table: Space, least: float) -> Iterator[tuple[str, np.ndarray]]:
    for k in range(0, len(words), 8192):
        close = word_kernels(words[k : k + 8192], table) > least
        for j in np.flatnonzero(close.any(axis=1)):
            yield words[k + j], np.flatnonzero(close[j])


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by Newton's method; the last weight is the offset."""
    w = np.zeros(x.shape[1] + 1)
    keep = penalty * np.eye(len(w))
    for _ in range(steps):
        g, h = keep @ w, keep.copy()
        for k in range(0, len(x), 8192):
            own = np.column_stack([x[k : k + 8192], np.ones(len(x[k : k + 8192]))]).astype(np.float64)
            inside = 1 - y[k : k + 8192] * (own @ w)
            on = inside > 0
            pull = weight[k : k + 8192][on]
            g -= own[on].T @ (pull * y[k : k + 8192][on] * inside[on])
            h += (own[on] * pull[:, None]).T @ own[on]
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit(texts: list[str], labels: list[int], counts: tuple[int, int] | None = None, rounds: int = 4) -> Machine | None:
    """A machine from labelled documents; None if a class has none. Copies of a text count once."""
    texts, labels = zip(*dict(zip(texts, labels)).items()) if texts else ((), ())
    y = np.array(labels, dtype=np.float64)
    if not (y == 0).any() or not (y == 1).any():
        return None
    number: dict[str, int] = {}  # each distinct word is held once
    split = [np.array([number.setdefault(w, len(number)) for w in tokens(t)], dtype=np.int32) for t in texts]
    vocabulary = list(number)
    bare = [_EDGE.sub("", w) for w in vocabulary]
    landmarks = _choose([{bare[k] for k in set(own.tolist()) if bare[k]} for own in split], y)
    if not landmarks:
        return None
    space = landmark_space(landmarks)
    ends = np.array([_ends(w) for w in vocabulary], dtype=bool)
    kernels = word_kernels(vocabulary, space)
    own = word_kernels(landmarks, space).astype(np.float64)  # symmetrical, with ones on the diagonal
    values, vectors = np.linalg.eigh((own + own.T) / 2 + 1e-6 * np.eye(len(landmarks)))
    white = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T

    features, doc = [], []
    for k, at in enumerate(split):
        if len(at):
            fresh = np.concatenate([[True], at[1:] != at[:-1]])
            for starts in training_sentences(ends[at]):
                features.append(np.add.reduceat(kernels[at] * fresh[:, None], starts, axis=0))
                doc.append(np.full(len(starts), k))
    raw, doc = np.concatenate(features), np.concatenate(doc)
    x = raw @ white.astype(np.float32)
    toxic = y[doc] == 1
    target = np.where(toxic, 1.0, -1.0)
    # At first the sentences of toxic documents that are nearest to a landmark of toxic words.
    near = raw[:, : max(1, len(landmarks) - COMMON)].max(axis=1)
    best = np.zeros(len(texts))
    np.maximum.at(best, doc, near)
    target[toxic & (near < 0.5 * best[doc])] = -1
    for _ in range(rounds):
        weight = np.where(target > 0, 0.5 / max((target > 0).sum(), 1), 0.5 / max((target < 0).sum(), 1))
        w = _machine(x, target, weight)
        margin = x @ w[:-1] + w[-1]
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, doc, margin)
        target = np.where(toxic & ((margin > 0) | (margin >= best[doc])), 1.0, -1.0)
    best[np.isneginf(best)] = w[-1]
    machine = Machine(landmarks, space, (white @ w[:-1]).astype(np.float32), float(w[-1]))
    machine.slope, machine.offset = calibrate(np.clip(best, -20, 20), y, shares(y, counts))
    return machine


def score_documents(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score``: one row per input row. Null text is empty; an empty text has no sentence and the score of the offset. Without a machine every score is 0. Other columns are no inputs."""
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # LANDMARKS columns, a row for each triple that one of them has

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            for begin, part in text_slices(b.column(1), SLICE_BYTES):
                score = np.zeros(len(part)) if own is None else own.score(part)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, len(part)), pa.array(score, pa.float64())], ["id", "score"])

    return source.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def fit_from(docs: DataFrame, labels: DataFrame) -> Machine | None:
    rows = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, TRAIN_EACH, TRAIN_CHARS).toPandas().sort_values(["doc_id", "text"])
    return fit(rows["text"].tolist(), rows["label"].tolist(), class_counts(labels, "toxic", FOLDS, HELD_OUT))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per document, repeated rows each; empty tables give an empty result."""
    scored = score_documents(docs, fit_from(docs, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
