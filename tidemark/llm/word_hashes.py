"""Words of a batch of texts as arrays of 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Bytes of text hashed at a time; a longer text is taken alone.
CHUNK_BYTES = 1_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true in the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of words: all but blanks; and letters, digits and what is beyond ASCII.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
WORDLIKE = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Words:
    """Word hashes of texts in order: text t has hashes[bounds[t]:bounds[t + 1]]."""

    hashes: np.ndarray
    bounds: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
    values[0x41:0x5B] = values[0x61:0x7B]  # A-Z as a-z
    return values


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes words of texts, A-Z lower-cased; word_bytes: which bytes belong to words."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self, word_bytes: np.ndarray) -> None:
        self.word_bytes, self.values = word_bytes, _byte_values()
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, texts: pa.Array) -> Words:
        """The words of an array of strings; a null counts as empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        n = len(data)
        if len(self.up) <= n:
            size = max(n + 1, CHUNK_BYTES + 1)
            self.up, self.down = _powers(size, self.BASE), _powers(size, pow(self.BASE, -1, 1 << 64))
        inside = np.concatenate([[False], self.word_bytes[data], [False]])
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True  # a word ends where its text ends
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * MULTIPLIER)
        return Words(hashes, np.searchsorted(starts, offsets))


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of about `size` bytes each."""
    start = total = 0
    for k, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
        if total and total + (n or 0) > size:
            yield start, texts.slice(start, k - start)
            start, total = k, 0
        total += n or 0
    if len(texts) > start:
        yield start, texts.slice(start)


def give_back() -> None:
    """Returns freed memory to the system at the end of a task: Python workers are used again for later stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
