"""Places in texts where keys of a table may stand, found in one pass over the texts by a table of bits.

The keys' hashes mark bits; their table has 2^27 bits (16 MB) at most, whatever the number of keys, and goes to all tasks. A place and a length whose
bits aren't all set hold no key and give no row. What is left, all places of keys and a few others, meets the keys by equality: where keys
outgrow the bits more rows do, none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The most bits, as a power of two; bits for each key; PIECE: letters of a text that are looked at together.
MOST, EACH, PIECE = 27, 32, 1 << 16
BASE = 0x9E3779B97F4A7C15
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _powers(n: int, base: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, base, "u8"))))


def _spots(h: np.ndarray, mixer: int, bits: int) -> np.ndarray:
    return ((h ^ (h >> np.uint64(29))) * np.uint64(mixer)) >> np.uint64(64 - bits)


class Hashes:
    """Hashes of any part of some strings put together."""

    def __init__(self, strings: list[str]):
        self.all = "".join(strings)
        self.letters = np.frombuffer(self.all.encode("utf-32-le"), "<u4")
        self.n = len(self.letters)
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum((self.letters.astype("u8") + np.uint64(1)) * _powers(self.n, BASE)[: self.n])))
        self.back = _powers(self.n, pow(BASE, -1, 1 << 64))

    def of(self, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[at]) * self.back[at]


def _marks(keys: DataFrame, bits: int) -> np.ndarray:
    """The table of bits of the keys (key), in words of 32."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strings = b.column(0).to_pylist()
            stop = np.cumsum([len(s) for s in strings], dtype="i8")
            h = Hashes(strings).of(np.concatenate(([0], stop[:-1])), stop)
            spots = np.concatenate([_spots(h, m, bits) for m in MIXERS])
            yield pa.RecordBatch.from_arrays([pa.array((spots >> np.uint64(5)).astype("i8")), pa.array(np.left_shift(1, (spots & np.uint64(31)).astype("i8")))], ["word", "mark"])

    found = keys.select("key").mapInArrow(marked, "word long, mark long").groupBy("word").agg(F.bit_or("mark").alias("mark")).toArrow()
    out = np.zeros(1 << (bits - 5), "u4")
    out[found.column("word").to_numpy()] = found.column("mark").to_numpy().astype("u4")
    return out


def possible(texts: DataFrame, keys: DataFrame, first: bool = False) -> DataFrame:
    """(id, start, length, key): where the distinct keys (key), none of them null or empty, may stand in texts (id, text); start counts from 0. All places where
    one stands are there, and some others. A null text has none. first: only at the
    beginnings of texts. The keys are read several times."""
    by_length = keys.groupBy(F.length("key").alias("k")).count().collect()
    lengths = sorted(r["k"] for r in by_length)
    bits = min(MOST, max(10, (EACH * sum(r["count"] for r in by_length)).bit_length()))
    marks = texts.sparkSession.sparkContext.broadcast(_marks(keys, bits))
    kind = texts.schema["id"].dataType.simpleString()

    def pieces(strings: list[str | None]) -> Iterator[list[tuple[int, int, str]]]:
        """(row, base, piece) in lots of bounded size; pieces of a text overlap by what a key may take."""
        lot, size = [], 0
        for row, s in enumerate(strings):
            for base in range(0, len(s or ""), PIECE):
                lot.append((row, base, s[base : base + PIECE + lengths[-1] - 1]))
                size += len(lot[-1][2])
                if size >= PIECE:
                    yield lot
                    lot, size = [], 0
        if lot:
            yield lot

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = marks.value
        for b in batches:
            ids = b.column(0)
            for lot in pieces(b.column(1).to_pylist()):
                size = np.array([len(p) for _, _, p in lot])
                h, ends = Hashes([p for _, _, p in lot]), np.cumsum(size)
                owner = np.repeat(np.arange(len(lot)), size)
                within = np.arange(h.n) - (ends - size)[owner]
                places = np.flatnonzero(within < PIECE)
                row, base = (np.array([x[i] for x in lot]) for i in (0, 1))
                if first:
                    places = places[(within[places] == 0) & (base[owner[places]] == 0)]
                for k in lengths:
                    at = places[places + k <= ends[owner[places]]]
                    hashes = h.of(at, at + k)
                    for m in MIXERS:
                        spots = _spots(hashes, m, bits)
                        hit = (table[spots >> np.uint64(5)] >> (spots & np.uint64(31)).astype("u4")) & np.uint32(1) != 0
                        at, hashes = at[hit], hashes[hit]
                    if len(at):
                        own = owner[at]
                        start = pa.array((base[own] + within[at]).astype("i4"))
                        keys_ = pa.array([h.all[i : i + k] for i in at.tolist()], pa.string())
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[own])), start, pa.array(np.full(len(at), k, "i4")), keys_], ["id", "start", "length", "key"])

    if not lengths:
        return texts.select("id", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("key")).where(F.lit(False))
    return texts.select("id", "text").mapInArrow(find, f"id {kind}, start int, length int, key string")
