"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import re

import numpy as np

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at a time; a step ends at white space.
_STEP = 1 << 22
_next_blank = re.compile(rb"[\x20\x09-\x0d]").search
_draw = np.random.default_rng(20)
#: Multipliers of a word's bytes by their place, and of a shingle's words. Longer words extend the first.
_places = _draw.integers(0, 2**64, 64, np.uint64) | np.uint64(1)
_turns = _draw.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: bytes) -> np.ndarray:
    global _places
    codes = np.frombuffer(data, np.uint8)
    word = ~_BLANK[codes]
    borders = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
    starts, ends = borders[::2], borders[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    if sizes.max() > len(_places):
        _places = np.random.default_rng(20).integers(0, 2**64, 2 * int(sizes.max()), np.uint64) | np.uint64(1)
    firsts = np.concatenate(([0], sizes.cumsum()[:-1]))
    place = np.arange(sizes.sum()) - np.repeat(firsts, sizes)
    return _mixed(np.add.reduceat((codes[word].astype(np.uint64) + np.uint64(1)) * _places[place], firsts))


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word, A to Z lower-cased, in order."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    if len(data) <= _STEP:
        return _hashes(data)
    out, start = [], 0
    while start < len(data):
        end = _next_blank(data, start + _STEP) if start + _STEP < len(data) else None
        stop = end.start() if end else len(data)
        out.append(_hashes(data[start:stop]))
        start = stop
    return np.concatenate(out)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of so many words, ascending. Fewer words are one shingle; none gives an empty set."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(words, len(h))
    size = len(h) - k + 1
    total = np.full(size, k, np.uint64)
    for i in range(k):
        total += h[i : i + size] * _turns[i]
    return np.unique(_mixed(total))
