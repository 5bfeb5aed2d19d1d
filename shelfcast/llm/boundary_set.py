"""A compressed set of byte positions with ``select``, in the manner of Roaring bitmaps.

Positions are split by their high bits into chunks of 2**16. The positions of a chunk lie in the smallest of three
containers: a sorted array, a bitmap, or a list of runs. The cardinalities of the containers are summed up, so the
k-th position is found by a binary search for its container and one select inside it.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 16
_BITMAP_BYTES = CHUNK // 8
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class ArrayContainer:
    """Sorted 16-bit positions: two bytes each."""

    def __init__(self, mask: np.ndarray):
        self.values = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """One bit per position; select counts bits byte by byte up to the one that holds the k-th."""

    def __init__(self, mask: np.ndarray):
        self.bits = np.packbits(mask, bitorder="little")

    def select(self, k: int) -> int:
        upto = np.cumsum(_POPCOUNT[self.bits], dtype=np.int64)
        byte = int(np.searchsorted(upto, k, side="right"))
        inside = np.flatnonzero(np.unpackbits(self.bits[byte : byte + 1], bitorder="little"))
        return 8 * byte + int(inside[k - (int(upto[byte - 1]) if byte else 0)])


class RunContainer:
    """Maximal runs as (first position, positions before the run): four bytes each."""

    def __init__(self, mask: np.ndarray):
        padded = np.concatenate([[False], mask, [False]])
        edges = np.flatnonzero(padded[1:] != padded[:-1])
        self.starts, ends = edges[::2], edges[1::2]
        self.before = np.cumsum(ends - self.starts) - (ends - self.starts)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container_of(mask: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for the set bits of a chunk."""
    n = int(np.count_nonzero(mask))
    if n == len(mask):
        return RunContainer(mask)
    runs = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0])
    sizes = {RunContainer: 4 * runs, ArrayContainer: 2 * n, BitmapContainer: _BITMAP_BYTES}
    return min(sizes, key=sizes.get)(mask)


class BoundarySet:
    """Containers of the non-empty chunks, their chunk numbers, and the positions before each."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        self.before = [0]

    def add_chunk(self, key: int, mask: np.ndarray) -> None:
        """Positions ``key * CHUNK + i`` of the set bits i; chunks come in ascending order."""
        n = int(np.count_nonzero(mask))
        if n:
            self.keys.append(key)
            self.containers.append(container_of(mask))
            self.before.append(self.before[-1] + n)

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, k: int) -> int:
        """The k-th smallest position, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return self.keys[at] * CHUNK + self.containers[at].select(k - self.before[at])


def utf8_boundaries(data: bytes) -> BoundarySet:
    """The byte offsets at which a code point of UTF-8 text starts, and its end.

    Chunk by chunk: beside the text only one chunk of plain flags exists at a time.
    """
    found = BoundarySet()
    octets = np.frombuffer(data, np.uint8)
    for lo in range(0, len(octets) + 1, CHUNK):
        mask = (octets[lo : lo + CHUNK] & 0xC0) != 0x80
        if len(mask) < CHUNK:
            mask = np.append(mask, True)  # the end of the text
        found.add_chunk(lo // CHUNK, mask)
    return found
