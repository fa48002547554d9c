"""Words of many texts at once, as 64-bit hashes, and hashes of runs of words.

A word is a run of letters, digits and characters beyond ASCII, in lower case; everything else stands
between words. All texts of a batch are one byte array, so a few passes of numpy do for all of them.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled, one to one."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[begin:end] for each span, from prefix sums of a polynomial modulo 2**64."""
    up, down = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    with np.errstate(over="ignore"):
        return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def lowered(text: str) -> str:
    """Lower case, character by character: the result has as many characters as the text."""
    return text.replace("\u0130", "i").lower()


def word_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first character and end of each word of all texts, and where each text's words begin (one more at the end)."""
    data = np.frombuffer(lowered("\n".join(texts)).encode() + b"\n", np.uint8)
    inside = _IN_WORD[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate([[0], change])
    begin, end = change[::2], change[1::2]
    hashes = span_hashes(data, begin, end)
    character = np.cumsum((data & 0xC0) != 0x80)
    begin, end = character[begin] - 1, character[end] - 1
    edge = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    starts = np.searchsorted(begin, edge)
    own = np.repeat(edge[:-1], np.diff(starts))
    return hashes, begin - own, end - own, starts


def shingles(hashes: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k words in a row inside a text, and where each text's shingles begin. A text of fewer words has one shingle of all of them; an empty text none."""
    n = np.diff(starts)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    begin = np.arange(first[-1]) - np.repeat(first[:-1] - starts[:-1], count)
    end = begin + np.repeat(np.minimum(n, k), count)
    return span_hashes(hashes, begin, end), first
