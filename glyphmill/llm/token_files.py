"""Token-ID / binary output: documents' ids in files of independent zstandard frames.

A file is made of zstandard frames, each with the ids of a few whole documents, then a skippable frame that lists the documents, then a
skippable frame with the seek table of Zstandard's public seekable format: compressed and decompressed size of each frame and the low 32
bits of the xxh64 of its content. Readers that know nothing of this decompress the file as one stream; those that do read the tail and
then only the frames of the documents they want, and check them.

Documents are dealt by ranges of doc_id, sorted in each range and written by the task that has it, a file a task, under a name of its
own. A task that is run again writes another file; the manifest, which Spark commits, names the files that count. Files go through
pyarrow's file systems to the shared folder, or to any folder with such a URI.

Defined cases: a null text is empty, so it has the end id only. Documents of null doc_id come first, equal doc_ids are ordered by a hash
of the text. Other columns of the input are ignored. An empty table gives no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.llm._tokens import encoder
from glyphmill.llm._words import chunks, tidy
from glyphmill.llm._work import new_folder, shuffle_parts, small_batches, stored

# Fixed values of the Zstandard formats.
SKIPPABLE_LIST, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
END_ID = 0
FRAME_IDS = 1 << 16
LEVEL = 3
_LIST = np.dtype([("id", "<i8"), ("none", "u1"), ("count", "<u4")])


class Writer:
    """Writes one file: add() documents in order, then finish()."""

    def __init__(self, out, width: str = "<u2"):
        self.out, self.width = out, np.dtype(width)
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_docs = 0
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, ids: np.ndarray, at: np.ndarray, names: np.ndarray, none: np.ndarray) -> None:
        """Documents' ids in a row, where each begins with the end, their doc_ids and which of those are null."""
        part = np.zeros(len(names), _LIST)
        part["id"], part["none"], part["count"] = names, none, np.diff(at)
        self.docs.append(part)
        self.n_docs += len(names)
        lo = 0
        while lo < len(names):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + FRAME_IDS - self.n_held, "right")) - 1)
            hi = min(hi, len(names))
            self.held.append(ids[at[lo] : at[hi]].astype(self.width))
            self.n_held += int(at[hi] - at[lo])
            lo = hi
            if self.n_held >= FRAME_IDS or lo < len(names):
                self._frame()

    def _frame(self) -> None:
        raw = b"".join(x.tobytes() for x in self.held)
        if raw:
            small = self.zip.compress(raw)
            self.out.write(small)
            self.frames.append((len(small), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.n_ids += self.n_held
        self.held, self.n_held = [], 0

    def finish(self) -> None:
        self._frame()
        table = zstandard.ZstdCompressor(level=LEVEL).compress(bytes([self.width.itemsize]) + b"".join(x.tobytes() for x in self.docs))
        self.out.write(struct.pack("<II", SKIPPABLE_LIST, len(table)) + table)
        seek = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek) + 9) + seek + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE))


class Reader:
    """Reads one file by its tail: documents' names and counts at once, ids on demand."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        seek = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3)
        self.size, self.raw, self.check = seek[:, 0].astype(np.int64), seek[:, 1].astype(np.int64), seek[:, 2]
        self.begin = np.cumsum(self.size) - self.size
        after = int(self.size.sum())
        magic, length = struct.unpack("<II", file.read_at(8, after))
        if magic != SKIPPABLE_LIST:
            raise ValueError("no list of documents after the frames")
        table = zstandard.ZstdDecompressor().decompress(file.read_at(length, after + 8))
        self.width = np.dtype(f"<u{table[0]}")
        self.docs = np.frombuffer(table, _LIST, offset=1)
        self.start = np.r_[0, np.cumsum(self.docs["count"].astype(np.int64))]
        self.first = np.r_[0, np.cumsum(self.raw // self.width.itemsize)]

    def frame(self, i: int) -> np.ndarray:
        raw = zstandard.ZstdDecompressor().decompress(self.file.read_at(int(self.size[i]), int(self.begin[i])))
        if len(raw) != self.raw[i] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.check[i]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(raw, self.width)

    def document(self, i: int) -> np.ndarray:
        """The ids of document i, from its frame only."""
        f = int(np.searchsorted(self.first, self.start[i], "right")) - 1
        return self.frame(f)[self.start[i] - self.first[f] : self.start[i + 1] - self.first[f]]

    def all(self) -> Iterator[tuple[int, np.ndarray]]:
        for f in range(len(self.size)):
            ids = self.frame(f)
            for i in range(int(np.searchsorted(self.start, self.first[f])), int(np.searchsorted(self.start, self.first[f + 1]))):
                yield i, ids[self.start[i] - self.first[f] : self.start[i + 1] - self.first[f]]


MANIFEST = "part int, file string, n_docs long, n_ids long"


def _write(folder: str, path: str, end_id: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = writer = None
        for batch in chunks(batches, "text", 1 << 20, 1 << 20):
            if not batch.num_rows:
                continue
            if writer is None:
                fs, at = pyarrow.fs.FileSystem.from_uri(folder)
                name = f"{at}/{uuid.uuid4().hex}.ids.zst"
                out = fs.open_output_stream(name, compression=None)
                writer = Writer(out, "<u2" if encoder(path, added).tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
            ids, start = encoder(path, added).encode(batch.column("text"))
            ids = np.insert(ids, start[1:], end_id)
            names = batch.column("doc_id")
            writer.add(ids, start + np.arange(len(start)), names.fill_null(0).to_numpy(), names.is_null().to_numpy(zero_copy_only=False))
        if writer is not None:
            writer.finish()
            out.close()
            uri = folder.rstrip("/") + "/" + name.rpartition("/")[2]
            columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([uri]), pa.array([writer.n_docs]), pa.array([writer.n_ids])]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "file", "n_docs", "n_ids"])

    return tidy(run)


def write_ids(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """Writes the files and gives their manifest (part, file, n_docs, n_ids), in the order of part. added: as for Encoder."""
    small_batches(docs.sparkSession)
    folder = folder or new_folder(docs.sparkSession, "ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(shuffle_parts(docs.sparkSession), *order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(_write(folder, tokenizer, end_id, added), MANIFEST), "manifest")


def _open(uri: str):
    fs, at = pyarrow.fs.FileSystem.from_uri(uri)
    return fs.open_input_file(at)


@tidy
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
            with _open(uri) as file:
                reader = Reader(file)
                crc = np.zeros(len(reader.docs), np.int64)
                for i, ids in reader.all():
                    crc[i] = zlib.crc32(ids.astype("<u4").tobytes())
                names = pa.array(reader.docs["id"], mask=reader.docs["none"] > 0)
                yield pa.RecordBatch.from_arrays([names, pa.array(base + reader.start[:-1]), pa.array(reader.docs["count"].astype(np.int64)), pa.array(crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files. start counts the ids of all documents before it."""
    base = F.coalesce(F.sum("n_ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("part", "file", base.alias("base"))
    return files.repartition(shuffle_parts(manifest.sparkSession), "part").mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(files: list[str], wanted: list[int]) -> dict[int, np.ndarray]:
    """The ids of the wanted doc_ids, decompressing their frames only."""
    found = {}
    for uri in files:
        with _open(uri) as file:
            reader = Reader(file)
            for i in np.flatnonzero(np.isin(reader.docs["id"], wanted) & (reader.docs["none"] == 0)):
                found[int(reader.docs["id"][i])] = reader.document(int(i))
    return found
