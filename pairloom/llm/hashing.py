"""Hashes of words and byte n-grams for whole Arrow columns of texts.

Bytes get fixed random numbers, with capital ASCII letters sharing those of the small ones, so
nothing has to be lower-cased first. Work goes in pieces of a quarter of a megabyte, so memory does not
follow the batch, nor the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _byte_numbers() -> np.ndarray:
    numbers = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    numbers[ord("A") : ord("Z") + 1] = numbers[ord("a") : ord("z") + 1]
    return numbers


_NUMBERS = _byte_numbers()
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(_BLANKS)] = False
# ASCII apart from letters and digits counts as one and the same sign.
_SIGNS = _NUMBERS.copy()
_SIGNS[[b for b in range(128) if not chr(b).isalnum()]] = _NUMBERS[0x20]

class _Powers:
    """Powers of the base and of its inverse, as many as the longest piece so far needs."""

    def __init__(self) -> None:
        self._up = self._down = np.empty(0, np.uint64)

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < count:
            steps = np.full((2, count), [[_BASE], [_INVERSE]])
            steps[:, 0] = 1
            self._up, self._down = np.multiply.accumulate(steps, axis=1)
        return self._up[:count], self._down[:count]


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def runs(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Rows ``[first, last)`` of about ``size`` bytes; a longer text is alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def _spaced(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts of some rows with a blank before each and one at the end, and where each text begins."""
    sizes = np.diff(offsets[first : last + 1])
    starts = offsets[first:last] - offsets[first] + np.arange(1, last - first + 1)
    out = np.full(int(sizes.sum()) + last - first + 1, 0x20, np.uint8)
    for k, start in enumerate(starts):
        out[start : start + sizes[k]] = data[offsets[first + k] : offsets[first + k] + sizes[k]]
    return out, starts


def _words_of(data: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in some bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IS_WORD[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    up, down = powers.get(max(1, len(data)))
    np.cumsum(_NUMBERS[data] * up[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * _U(0xD6E8FEB86659FD93)), starts


def _long_words(text: np.ndarray, powers: _Powers) -> np.ndarray:
    """Word hashes of one long text, a piece at a time; pieces end at a blank."""
    out, at = [], 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and _IS_WORD[text[end]]:
            step = np.flatnonzero(~_IS_WORD[text[end : end + PIECE]])
            end = end + int(step[0]) if len(step) else min(end + PIECE, len(text))
        out.append(_words_of(text[at:end], powers)[0])
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, hashes, ends)``: the words of some rows in order, and where each row's words end."""
    data, offsets = _raw(texts)
    powers = _Powers()
    for first, last in runs(offsets, PIECE):
        if last - first == 1 and offsets[last] - offsets[first] > PIECE:
            hashes = _long_words(data[offsets[first] : offsets[last]], powers)
            yield first, hashes, np.array([len(hashes)])
            continue
        spaced, starts = _spaced(data, offsets, first, last)
        hashes, words = _words_of(spaced, powers)
        yield first, hashes, np.append(np.searchsorted(words, starts[1:]), len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` words, in order; a shorter text is one run."""
    count = len(words)
    if not count:
        return words
    wide = min(size, count)
    total = mix(words[: count - wide + 1] + _U(wide))
    for k in range(1, wide):
        total = mix(total * _U(3) + words[k : count - wide + 1 + k])
    return total


def byte_grams(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, hashes, rows)``: hashes of every run of ``size`` bytes and the row of each, counted from the first.

    ASCII signs and blanks are all alike, and one stands before and after each text.
    """
    data, offsets = _raw(texts)
    for first, last in runs(offsets, PIECE):
        if last - first > 1 or offsets[last] - offsets[first] <= PIECE:
            spaced, starts = _spaced(data, offsets, first, last)
            grams = _grams(spaced, size)
            # A run of two texts belongs to neither; the sign between them is the end of one and the start of the other.
            at = np.arange(len(grams))
            rows = np.searchsorted(starts, at + 1, side="right") - 1
            ends = starts + np.diff(offsets[first : last + 1])
            inside = at + size - 1 <= ends[rows]
            yield first, grams[inside], rows[inside]
            continue
        text = np.concatenate([[0x20], data[offsets[first] : offsets[last]], [0x20]]).astype(np.uint8)
        for at in range(0, len(text) - size + 1, PIECE):
            grams = _grams(text[at : at + PIECE + size - 1], size)
            yield first, grams, np.zeros(len(grams), np.int64)


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    count = len(data) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    numbers = _SIGNS[data]
    total = numbers[:count].copy()
    for k in range(1, size):
        total *= _BASE
        total += numbers[k : k + count]
    return mix(total)
