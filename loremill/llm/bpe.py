"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

Encoding a word: an Aho-Corasick automaton over all tokens gives the longest token that starts at each
place. The encoder walks from left to right with these, and takes a token only if the
pair-compatibility table says that merging would leave it and its predecessor as they are; otherwise
it tries the token's next shorter prefix, and steps back when there is none. A place from which no way
led on is never tried again, so the work is linear in the word and the result is what applying the
merges in order would give.

Words repeat, so each Python worker keeps the ids of words it has met in a cache of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: How words end in the vocabulary file, and the one character that stands for it here (no byte maps to it).
WORD_END, END = "</w>", " "
#: Words longer than this are encoded each time; the cache holds two generations of at most so many words.
CACHED_CHARS, CACHED_WORDS = 48, 400_000
SLICE = 1 << 16


@functools.cache
def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordCache(dict):
    """``self[word]`` is ``compute(word)``; the words used least lately are forgotten, a generation at a time."""

    def __init__(self, compute: Callable[[str], object], words: int = CACHED_WORDS) -> None:
        self.compute, self.words, self.old = compute, words, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.words:
                self.old = dict(self)
                self.clear()
            self[word] = value
        return value


class Bpe:
    """Tokens are numbered by merge order inside (single symbols first); ``ids`` has the vocabulary's numbers."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [tuple(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        number: dict[str, int] = {}
        self.text: list[str] = []
        for c in byte_alphabet():
            for name, symbol in ((c, c), (c + WORD_END, c + END)):
                number[name] = len(self.text)
                self.text.append(symbol)
        names = list(number)
        self.left, self.right = list(range(len(names))), list(range(len(names)))
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:
            if (name := a + b) in number:
                raise ValueError(f"two merges make {name!r}; pair compatibility needs one")
            left, right = number[a], number[b]
            number[name] = self.pairs[left, right] = len(names)
            names.append(name)
            self.text.append(self.text[left] + self.text[right])
            self.left.append(left)
            self.right.append(right)
        self.ids = np.array([vocab[n] for n in names], dtype="<u4")
        self.length = [len(t) for t in self.text]
        by_text = {t: i for i, t in enumerate(self.text)}
        self.shorter = [next((by_text[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_text), -1) for t in self.text]
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.text):
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.table: dict[tuple[int, int], bool] = {}
        self.to_symbols = str.maketrans({chr(b): c for b, c in enumerate(byte_alphabet())})
        # Fixed pattern of the vocabulary's pre-tokenizer. It sees stand-ins of known kind for what is beyond ASCII.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        self.kinds = Kinds(path)
        self.tail = regex.compile(r"(?<=[\p{L}\p{N}])[^'\p{White_Space}\p{L}\p{N}]+$")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.marks = {s[0] for s in self.special}
        self.words = WordCache(self._chunk)
        #: Offset table for decoding: token i of the vocabulary is bytes offsets[i]:offsets[i + 1] of blob, with a blank after it.
        by_id = {**{i: n for n, i in vocab.items()}, **{i: n for n, i in self.special.items()}}
        parts = [by_id.get(i, "").encode() + b" " for i in range(max(by_id) + 1)]
        self.blob = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.cumsum([0, *map(len, parts)])

    def compatible(self, a: int, b: int) -> bool:
        """Would merging the text of ``a`` and ``b`` end in these two tokens? Undo their merges, latest first, and look for an earlier merge across."""
        known = self.table.get((a, b))
        if known is None:
            x, y, limit, known = a, b, len(self.text), True
            while True:
                merged = self.pairs.get((x, y))
                if merged is not None and merged < limit:
                    known = False
                    break
                later_left = x > y
                if later_left:
                    limit, x = x, self.right[x]
                    stuck = x == limit
                    if stuck:
                        limit, y = y + 1, self.left[y]
                        stuck = y + 1 == limit
                else:
                    limit, y = y + 1, self.left[y]
                    stuck = y + 1 == limit
                    if stuck:
                        limit, x = x, self.right[x]
                        stuck = x == limit
                if stuck:
                    break
            if len(self.table) >= 2_000_000:
                self.table.clear()
            self.table[a, b] = known
        return known

    def encode_word(self, symbols: str) -> list[int]:
        """Own token numbers of a word given as byte symbols with END after the last."""
        n = len(symbols)
        longest = [-1] * n
        for last, (token, length) in self.automaton.iter(symbols):
            longest[last - length + 1] = token
        open_ = [x >= 0 for x in longest] + [True]
        shorter, size, compatible = self.shorter, self.length, self.compatible
        found: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            before = found[-1] if found else -1
            while not (open_[at + size[token]] and (before < 0 or compatible(before, token))):
                token = shorter[token]
                if token < 0:
                    break
            if token >= 0:
                found.append(token)
                at += size[token]
                token = longest[at] if at < n else -1
            else:
                open_[at] = False
                token = found.pop()
                at -= size[token]
        return found

    def _piece(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self.to_symbols) + END
        return self.ids[self.encode_word(symbols)].tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a run of characters that are no white space."""
        kinds = chunk if chunk.isascii() else chunk.translate(self.kinds)
        if m := self.tail.search(kinds):  # punctuation at the end is a piece by itself
            return self.words[chunk[: m.start()]] + self.words[chunk[m.start() :]]
        return b"".join(self._piece(chunk[m.start() : m.end()]) for m in self.split.finditer(kinds))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.cut and any(m in text for m in self.marks):
            return b"".join(
                self.special[x].to_bytes(4, "little") if x in self.special else b"".join(map(self.words.__getitem__, chunks(x, self.path))) for x in self.cut.split(text)
            )
        return b"".join(map(self.words.__getitem__, chunks(text, self.path)))

    def decode(self, ids: np.ndarray) -> Iterator[bytes]:
        """The decoded text in UTF-8, in parts: each token's bytes by its offsets, blanks between tokens."""
        for k in range(0, len(ids), SLICE):
            own = ids[k : k + SLICE]
            start = self.offsets[own]
            size = self.offsets[own + 1] - start
            ends = np.cumsum(size)
            where = np.repeat(start - (ends - size), size)
            where += np.arange(len(where))
            yield self.blob[where[: len(where) - (k + SLICE >= len(ids))]].tobytes()


#: Characters that str.split() takes for white space but Unicode does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = regex.compile(r"\p{White_Space}+")
#: Below U+0300 nothing composes, and case has not changed since; beyond, the library's own tables count.
_BEYOND = re.compile("[^\x00-\u02ff]")


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The tokenizers library's tokenizer, for its tables of characters. One for each Python worker and file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Kinds(dict):
    """A stand-in for each character beyond ASCII: a letter, a digit or a mark, as the library's pre-tokenizer takes it. Each is asked once."""

    def __init__(self, path: str) -> None:
        self.cut = library(path).pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if code >= 128:
            c = "\xe4" if len(self.cut("a" + c)) == 1 else "#" if len(self.cut("#" + c)) == 1 else "1"
        self[code] = c
        return c


def _simple(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return not _BEYOND.search(text)


def chunks(text: str, path: str) -> list[str]:
    """The normalised text (NFC, lower case letter by letter) at white space."""
    if not _simple(text):
        return [x for x in library(path).normalizer.normalize_str(text).split(" ") if x]
    text = text.lower()
    if _SEPARATORS.search(text):
        return [x for x in _WHITE.split(text) if x]
    return text.split()


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One for each Python worker and file."""
    return Bpe(path)


def texts(column: pa.Array | pa.ChunkedArray, rows: int = 128) -> Iterator[str]:
    """The strings of a column, some at a time; null is empty."""
    for k in range(0, len(column), rows):
        for x in column.slice(k, rows).to_pylist():
            yield x or ""


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>``: one row per input row. Null text is empty and has no ids; other columns are ignored."""
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            ids = [np.frombuffer(bpe.encode(t), "<u4").astype("i4") for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return source.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text``: one row per input row. No ids, or null, give the empty text."""
    source = encoded.select(id_col, ids_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            out = [b"".join(bpe.decode(np.asarray(x or [], dtype=np.int64))).decode() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["id", "text"])

    return source.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encodes and decodes each whole text, and keeps digests only."""
    source = docs.select(id_col, text_col)
    kind = dict(source.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in texts(b.column(1)):
                raw = bpe.encode(t)
                n.append(len(raw) // 4)
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                digest = hashlib.sha256()
                for part in bpe.decode(np.frombuffer(raw, "<u4").astype(np.int64)):
                    digest.update(part)
                text_sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
