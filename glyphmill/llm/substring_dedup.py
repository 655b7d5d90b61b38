"""Substring dedup: word windows that an earlier document already holds are removed.

Rabin-Karp hashes of every window of ``width`` words are dealt to tasks by their value, packed: one binary row for each chunk of
documents and task, in which documents and positions are delta coded, about ten bytes a window. Before that, a chunk keeps of each
window only its smallest document, since the others in the chunk are already known to repeat; so a window that a third of all
documents hold reaches its task once a chunk and not once a document. The tasks answer with the positions to remove, packed for the
tasks that put them together by document; those rows meet the texts in one join; overlapping windows merge into maximal intervals there.

Rows that share a doc_id are told apart by a 64-bit hash of their text, so rows of equal id and hash get the same removals.

Defined cases: a null or empty text has no words. A null doc_id counts as 2^63 - 1, so as larger than any other but that. Equal doc_ids
don't remove from each other; equal rows get equal results. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._words import Words, chunks, flat, tidy
from glyphmill.llm._work import shuffle_parts, small_batches

NO_ID = (1 << 63) - 1
BYTES_AT_ONCE = 6 << 20


def _pack(ids: np.ndarray, mark: np.ndarray, doc: np.ndarray, pos: np.ndarray, value: np.ndarray | None) -> bytes:
    """Entries sorted by doc and pos. value is None for positions that are removed for sure."""
    at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    own = doc[at]
    step = np.diff(pos, prepend=pos.dtype.type(0))
    step[at] = pos[at]
    parts = [np.diff(ids[own], prepend=0), mark[own], np.diff(np.r_[at, len(doc)]).astype(np.uint32), step.astype(np.int32)]
    head = np.array([value is None, len(own), len(doc)], np.int64).tobytes()
    small = zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))
    return head + len(small).to_bytes(8, "little") + small + (b"" if value is None else value.tobytes())


def _unpack(blob: bytes) -> tuple[bool, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    sure, docs, n = np.frombuffer(blob, np.int64, 3)
    size = int.from_bytes(blob[24:32], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[32 : 32 + size])
    ids = np.cumsum(np.frombuffer(raw, np.int64, docs))
    mark = np.frombuffer(raw, np.int64, docs, 8 * docs)
    count = np.frombuffer(raw, np.uint32, docs, 16 * docs).astype(np.int64)
    step = np.frombuffer(raw, np.int32, n, 20 * docs).astype(np.int64)
    total = np.cumsum(step)
    first = np.cumsum(count) - count
    pos = total - np.repeat(total[first] - step[first], count)
    return bool(sure), ids, mark, count, pos, None if sure else np.frombuffer(blob, np.uint64, n, 32 + size)


def _windows(width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BYTES_AT_ONCE, BYTES_AT_ONCE):
            batch = batch.take(pa.compute.sort_indices(batch.column("id")))
            ids = batch.column("id").to_numpy()
            mark = batch.column("mark").to_numpy()
            words = Words(batch.column("text"))
            value, where = words.windows(width)
            doc = words.row()[where].astype(np.int32)
            pos = (where - words.first[doc]).astype(np.int32)
            del words, where
            order = np.argsort(value)
            new = np.flatnonzero(np.r_[True, value[order][1:] != value[order][:-1]]) if len(order) else order
            own = ids[doc[order]]
            least = np.minimum.reduceat(own, new) if len(order) else order
            known = np.zeros(len(value), bool)
            known[order] = own > np.repeat(least, np.diff(np.r_[new, len(order)]))
            del order, new, own, least
            part = (value >> np.uint64(32)).astype(np.int64) % parts
            rows: list[tuple[int, bytes]] = []
            sent = np.flatnonzero(~known)
            sent = sent[np.argsort(part[sent], kind="stable")]
            for piece in np.split(sent, np.flatnonzero(np.diff(part[sent])) + 1):
                if len(piece):
                    rows.append((int(part[piece[0]]), _pack(ids, mark, doc[piece], pos[piece], value[piece])))
            gone = np.flatnonzero(known)
            if len(gone):
                rows.append((int(gone[0]) % parts, _pack(ids, mark, doc[gone], pos[gone], None)))
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["part", "entries"])

    return tidy(run)


def _repeats(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One task's windows: what a smaller document holds too, packed for the tasks of the documents."""
        got: list[tuple] = []
        for batch in batches:
            for blob in batch.column("entries"):
                sure, ids, mark, count, pos, value = _unpack(blob.as_py())
                if sure:
                    yield from _to_documents(np.repeat(ids, count), np.repeat(mark, count), pos.astype(np.int32), parts)
                else:
                    got.append((ids, mark, count.astype(np.int32), pos.astype(np.int32), value))
        if got:
            columns = list(zip(*got, strict=True))
            got.clear()
            value = np.concatenate(columns.pop())
            pos = np.concatenate(columns.pop())
            ids, mark = (np.repeat(np.concatenate(x), np.concatenate(columns[2])) for x in columns[:2])
            columns.clear()
            order = np.argsort(value)
            value = value[order]
            new = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
            del value
            least = np.minimum.reduceat(ids[order], new)
            gone = order[ids[order] > np.repeat(least, np.diff(np.r_[new, len(order)]))]
            del order, new, least
            yield from _to_documents(ids[gone], mark[gone], pos[gone], parts)

    return tidy(run)


def _to_documents(ids: np.ndarray, mark: np.ndarray, pos: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    part = (ids ^ mark) % parts
    order = np.lexsort((pos, mark, ids, part))
    ids, mark, pos, part = ids[order], mark[order], pos[order], part[order]
    edge = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (mark[1:] != mark[:-1])]) if len(ids) else order
    doc = np.repeat(np.arange(len(edge), dtype=np.int32), np.diff(np.r_[edge, len(ids)]))
    rows = [(int(part[own[0]]), _pack(ids[edge], mark[edge], doc[own], pos[own], None)) for own in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(part)) + 1) if len(own)]
    yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())], names=["part", "entries"])


@tidy
def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, mark, the positions to remove), one row for each document that has any."""
    got = [_unpack(blob.as_py())[1:5] for batch in batches for blob in batch.column("entries")]
    if not got:
        return
    ids, mark = (np.concatenate([np.repeat(x[i], x[2]) for x in got]) for i in range(2))
    pos = np.concatenate([x[3].astype(np.int32) for x in got])
    order = np.lexsort((mark, ids))
    ids, mark, pos = ids[order], mark[order], pos[order]
    at = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (mark[1:] != mark[:-1])])
    for lo in range(0, len(at), 4096):
        own = at[lo : lo + 4096]
        end = np.r_[at[lo + 1 : lo + 4096], at[lo + 4096] if lo + 4096 < len(at) else len(ids)]
        values = pa.array([pos[a:b].tobytes() for a, b in zip(own, end, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(mark[own]), values], names=["id", "mark", "at"])


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            out: list[tuple] = []
            buf, at = flat(batch.column("text"))
            for i, places in enumerate(batch.column("at").to_pylist()):
                words = buf[at[i] : at[i + 1]].tobytes().split()
                n, spans = len(words), []
                if places:
                    edge = np.zeros(n + 1, np.int64)
                    first = np.unique(np.frombuffer(places, np.int32))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + width, -1)
                    covered = np.cumsum(edge)[:n] > 0
                    turn = np.flatnonzero(np.diff(np.r_[False, covered, False]))
                    spans = [{"from": int(a), "to": int(b)} for a, b in zip(turn[::2], turn[1::2], strict=True)]
                    words = [words[j] for j in np.flatnonzero(~covered)]
                out.append((n, n - len(words), spans, b" ".join(words).decode("utf-8", "replace"), hashlib.sha256(b" ".join(words)).hexdigest()))
            n, removed, spans, kept, sha = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), pa.array(kept, pa.string()), pa.array(sha, pa.string())],
                names=["doc_id", "n_words", "n_removed", "removed", "kept", "kept_sha256"],
            )

    return tidy(run)


def substring_dedup(docs: DataFrame, width: int = 13) -> DataFrame:
    """(doc_id, n_words, n_removed, removed: intervals of word numbers, kept: the text left, kept_sha256) of each row of docs."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = shuffle_parts(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    entries = rows.select("id", "mark", "text").mapInArrow(_windows(width, parts), "part int, entries binary")
    repeats = entries.repartitionById(parts, "part").mapInArrow(_repeats(parts), "part int, entries binary")
    removals = repeats.repartitionById(parts, "part").mapInArrow(_by_document, "id long, mark long, at binary")
    met = rows.join(removals, ["id", "mark"], "left").select("doc_id", "text", "at")
    return met.mapInArrow(_cut(width), "doc_id long, n_words long, n_removed long, removed array<struct<from: long, to: long>>, kept string, kept_sha256 string")
