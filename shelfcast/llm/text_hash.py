"""Hashes of the words, shingles and lines of many texts at once, on Arrow string columns.

A batch is cut into slices of about a megabyte, so memory does not follow the batch; a text is
never cut, so one very long text makes one larger slice. All hashes are 64 bits wide and equal
on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the splitmix finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))
_PLACE = [_U(2 * int(x) + 1) for x in mix(np.arange(77, 77 + 64, dtype=np.uint64)) >> _U(1)]


class _Powers:
    """Powers of the base and of its inverse, made as far as a slice needs them."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + (1 << 16))
            self.up = np.cumprod(np.r_[_U(1), np.full(size - 1, _BASE, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[_U(1), np.full(size - 1, _INVERSE, np.uint64)], dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in them); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for every span; empty spans hash alike."""
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes not ``outside``, ASCII white space), words before each row."""
    inside = ~outside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.r_[False, inside[:-1]] if len(data) else inside
    after = np.r_[inside[1:], False] if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, A-Z lower-cased with ``fold``, and the words before each row."""
    starts, ends, upto = word_spans(data, offsets)
    return span_hashes(_FOLD[data] if fold else data, starts, ends), upto


_OTHER = np.ones(256, dtype=bool)
_OTHER[97:123] = _OTHER[65:91] = _OTHER[128:] = False


def letter_features(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of letters and of its first bytes, A-Z lower-cased; (hashes [word, kind], words before each row).

    Bytes above 127 count as letters, so words of any UTF-8 script stay whole. The prefix of a word that
    is not longer is the word itself under another name.
    """
    starts, ends, upto = word_spans(data, offsets, _OTHER)
    folded = _FOLD[data]
    kinds = [span_hashes(folded, starts, ends)]
    for i, n in enumerate(prefixes, 1):
        kinds.append(mix(span_hashes(folded, starts, np.minimum(ends, starts + n)) + _U(i)))
    return np.stack(kinds, axis=1), upto


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the \\n-split lines of every row, and the lines before each row; an empty text is one line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    upto = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    return starts, ends, upto


def shingle_sets(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row.

    Under ``k`` words the whole sequence is one shingle; without words the set is empty.
    """
    for lo, hi, data, offsets in slices(column):
        hashes, upto = words(data, offsets)
        count = max(0, len(hashes) - k + 1)
        whole = np.zeros(count, np.uint64)
        for i in range(k):
            whole += hashes[i : i + count] * _PLACE[i]
        whole = mix(whole)
        for row in range(hi - lo):
            a, b = int(upto[row]), int(upto[row + 1])
            if b - a >= k:
                yield np.unique(whole[a : b - k + 1])
            elif b > a:
                part = hashes[a:b] * np.array(_PLACE[: b - a])
                yield mix(part.sum(dtype=np.uint64, keepdims=True) + _U(b - a))
            else:
                yield np.zeros(0, np.uint64)
