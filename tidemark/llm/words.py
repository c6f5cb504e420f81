"""The words of many texts at once, as numpy arrays: a word is a longest run of bytes that are not ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once within a task. A longer text is handled alone, whole.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size, made = max(n, SLICE_BYTES + 1), []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if size > 4 * SLICE_BYTES:  # do not keep what one very long text needed
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


@dataclass
class Words:
    """`first[d]` to `first[d + 1]` are the words of text d; word w is `data[start[w]:end[w]]`."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word, a function of its bytes alone."""
        power, inverse = _powers_to(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * power[: len(self.data)], out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        return mix64((total[self.end] - total[self.start]) * inverse[self.start] + length)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Null texts have no words. `lower` maps A-Z to a-z and nothing else."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    if not size:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(texts) + 1, np.int64))
    inside = ~_SPACE[data]
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer text is a range of its own."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > limit:
            yield begin, i
            begin, held = i, 0
        held += int(n)
    if begin < len(texts):
        yield begin, len(texts)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct runs of `width` words as sorted 64-bit hashes; fewer words are one run; none, none."""
    odd = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    w = words_of(texts, lower=True)
    h = w.hashes()
    runs = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for j in range(width):
        runs += h[j : j + len(runs)] * odd[j]
    runs = mix64(runs)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= width:
            s = np.sort(runs[a : b - width + 1])
            yield s if len(s) < 2 else s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield mix64(np.array([(h[a:b] * odd[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)]))
        else:
            yield np.zeros(0, np.uint64)
