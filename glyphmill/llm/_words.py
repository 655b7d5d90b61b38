"""Words of many texts at once, as numpy arrays over the Arrow buffers that Spark hands to Python.

A word is a maximal run of bytes outside a set of ASCII delimiters, so runs can be found on UTF-8 bytes without decoding.
Every word gets a 64-bit hash: a polynomial over its bytes (prefix sums, so one pass for all words) that is mixed afterwards.
Texts are handled in pieces of a few MB, so memory doesn't follow the length of the longest text, save for a few bytes a word.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
CHUNK = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[48:58] = False
NOT_ALNUM[97:123] = False


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and where each row starts; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK, least: int = 0) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``limit`` bytes of text at most (one row at least); small batches are put together
    until they hold ``least`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = flat(batch.column(text))[1]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            held.append(batch.slice(lo, hi - lo))
            size += int(at[hi] - at[lo])
            lo = hi
            if size >= least:
                yield together(held)
                held, size = [], 0
    if held:
        yield together(held)


def trim() -> None:
    """Gives memory that isn't in use back to the system: workers stay, and the next job's share an executor with these."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run, and trim() after each partition."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return inner


def together(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Words:
    """Words of the rows of one column. hash, start, end: of each word; first: index of the first word of each row, and the end."""

    def __init__(self, column: pa.Array, delimiters: np.ndarray = SPACES, fold: bool = False):
        buf, at = flat(column)
        if fold:
            buf = FOLD[buf]
        self.buf, self.rows = buf, len(at) - 1
        inside = ~delimiters[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[at] = True
        before = np.empty_like(inside)
        if len(inside):
            before[0] = False
            before[1:] = inside[:-1]
            self.start = np.flatnonzero(inside & (~before | edge[:-1]))
            after = np.empty_like(inside)
            after[-1] = False
            after[:-1] = inside[1:]
            self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, at)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), np.uint64)
        lo = 0
        while lo < len(out):
            hi = max(lo + 1, int(np.searchsorted(self.end, self.start[lo] + PIECE, "right")))
            zero = int(self.start[lo])
            part = self.buf[zero : self.end[hi - 1]].astype(np.uint64)
            part += np.uint64(1)
            part *= powers(_BASE, len(part))
            total = np.empty(len(part) + 1, np.uint64)
            total[0] = 0
            np.cumsum(part, out=total[1:])
            s, e = self.start[lo:hi] - zero, self.end[lo:hi] - zero
            out[lo:hi] = (total[e] - total[s]) * powers(_UNBASE, len(part))[s] ^ ((e - s).astype(np.uint64) << np.uint64(48))
            lo = hi
        return mix(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.rows), self.counts())

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on (Rabin-Karp over word hashes), and the words that have k words from there in
        their row."""
        n = len(self.hash)
        last = np.repeat(self.first[1:], self.counts())
        whole = np.flatnonzero(np.arange(n) + k <= last)
        out = np.zeros(len(whole), np.uint64)
        for j in range(k):
            out *= np.uint64(0xD6E8FEB86659FD93)
            out += self.hash[whole + j]
        return mix(out), whole
