"""Words as the contracts define them, on UTF-8 bytes.

``bytes.split`` cuts at exactly the white space ``[\\x20\\x09-\\x0D]``, and ``bytes.lower``
changes exactly A-Z, so both give ``[^\\x20\\x09-\\x0D]+`` without a regular expression.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word to 64-bit hash; starts anew when it holds ``limit`` words, so memory is bounded."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection that spreads bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of ``size`` words, order included; a shorter text is one window."""
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(size, len(hashes))):
        out = mixed((out + hashes[k : k + n]) * _MIX)
    return out


def texts(batch: pa.RecordBatch, column: int = 1) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string column, one text at a time and without copies of the rest."""
    values = batch.column(column).cast(pa.large_binary())
    for value in values:
        yield value.as_py()


def keep_heap(size: int = 1 << 26) -> None:
    """Freed arrays stay with the process, up to ``size`` bytes, so that those of the next step cost no page faults."""
    with suppress(OSError, AttributeError):
        malloc_option = ctypes.CDLL(None).mallopt
        malloc_option(-3, min(size, 1 << 25))  # arrays up to this size come from the heap
        malloc_option(-1, size)  # and the heap is not cut back before so much of it is free


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, and what memory it leaves free goes back to the system: Python workers outlive their tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return tidied
