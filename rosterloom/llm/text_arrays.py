"""Words of many texts as numpy arrays: where they are, and 64-bit hashes of them."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


#: Bytes whose 64-bit sums are in memory at a time; a word that is longer stands alone.
BLOCK = 1 << 18
_LIBC = ctypes.CDLL(None)


def give_back() -> None:
    """What freed arrays held goes back to the machine, so that a worker which waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


class _Powers:
    """Powers of the factor and of its inverse; `BLOCK` of them are kept, more are made for one use."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > BLOCK + 1:
            return self._of(_FACTOR, n), self._of(_INVERSE, n)
        if len(self.up) < n:
            self.up = self._of(_FACTOR, BLOCK + 1)
            self.down = self._of(_INVERSE, BLOCK + 1)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _of(factor: int, n: int) -> np.ndarray:
        out = np.full(n, factor, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_POWERS = _Powers()


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Sums along the last axis, from which hashes of stretches follow."""
    up, _ = _POWERS.to(data.shape[-1] + 1)
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= up[:-1]
    np.cumsum(values, axis=-1, out=out[..., 1:])
    return out


def stretch_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes starts[i]:ends[i], independent of where they stand; both ascend and stretches don't overlap."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        begin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
        sums = byte_sums(data[begin : ends[last - 1]])
        _, down = _POWERS.to(len(sums))
        low, high = starts[first:last] - begin, ends[first:last] - begin
        out[first:last] = mixed((sums[high] - sums[low]) * down[low])
        first = last
    return out


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A lookup table over bytes, true in the given inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


class Words:
    """Words of a batch of texts: runs of bytes of a set. `first[i]:first[i + 1]` are those of text i."""

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray, separator: bytes = b"\n") -> None:
        self.raw = separator.join(texts) + separator
        data = np.frombuffer(self.raw, np.uint8)
        edges = np.diff(word_bytes[data].view(np.int8), prepend=0, append=0)
        self.data = data
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        at = np.concatenate(([0], np.cumsum(sizes)))
        self.first = np.searchsorted(self.starts, at)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """Hashes of the words' bytes, independent of where a word stands."""
        return stretch_hashes(self.data, self.starts, self.ends)

    def prefix_hashes(self, which: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first `size` bytes of the words `which`, all at least that long."""
        low = self.starts[which]
        return stretch_hashes(self.data, low, low + size)

    def text(self, begin: int, end: int) -> bytes:
        """The words begin..end-1, parted by single spaces."""
        raw = self.raw
        return b" ".join(
            [raw[a:z] for a, z in zip(self.starts[begin:end].tolist(), self.ends[begin:end].tolist(), strict=True)]
        )


def grouped(texts: Iterable[str | None], size: int = 1 << 20) -> Iterator[list[bytes]]:
    """UTF-8 of the texts (null: empty) in lists of about `size` bytes; a longer text is a list of its own."""
    group: list[bytes] = []
    total = 0
    for text in texts:
        raw = text.encode() if isinstance(text, str) else b""
        if group and total + len(raw) > size:
            yield group
            group, total = [], 0
            give_back()
        group.append(raw)
        total += len(raw)
    if group:
        yield group
    give_back()
