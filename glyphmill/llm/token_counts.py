"""Token counts that follow edits: a segment tree over the pieces of each document.

A document is cut into leaves at places where the tokenizer's pre-tokens begin whatever stands around them. A leaf holds its count of
ids, an inner node the sum of its two children. An edit replaces a span: only the leaves that it touches are put together, changed and
encoded again, with a neighbour where the change meets a leaf's edge and the cut there no longer is one, be it that an added token's
text now lies across it. Their new count goes to the
first of them and the sums above are updated, so an edit costs the touched leaves and the depth of the tree, not the text. A second
tree over the leaves' lengths finds the leaf of a place.

token_trees() gives the trees of all documents, to be written; edited() takes them on from there, any number of times. counts_from_trees() keeps
the trees of all documents, takes edits as a table and counts from the updated trees. In token_counts()
counting and editing are one pass, and only documents with edits need a tree. In both edits are spans of a pattern to replace, by default e-mail addresses and numbers of six digits and more. Leaves of all documents of
a batch are encoded together, once before and once after.

Defined cases: a null or empty text has no leaf and 0 ids. Edits in a text don't overlap; they are applied from left to right. Repeated
rows get equal results. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._tokens import cuts, encoder
from glyphmill.llm._words import chunks, flat, tidy
from glyphmill.llm._work import meet, small_batches, stored

ADDRESS = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+")
DIGITS = re.compile(r"\d{6,}")
LEAF = 512
Edit = tuple[int, int, str]


def leaf_bounds(column: pa.Array, least: int = LEAF, whole: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all rows, where leaves begin with the end, and each row's first leaf with the end."""
    buf, at = flat(column)
    where = cuts(buf, at, whole)
    bounds, first = [], [0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        while a < b:
            bounds.append(a)
            i = int(np.searchsorted(where, a + least))
            a = min(b, int(where[i])) if i < len(where) else b
        first.append(len(bounds))
    return buf, np.array([*bounds, at[-1]], np.int64), np.array(first)


def as_rows(buf: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(buf)))


def joins(left: str, right: str, whole: tuple[bytes, ...] = ()) -> bool:
    """Whether the place between two texts is no cut."""
    n = max([2, *map(len, whole)])
    near = pa.array([left[-n:] + right[:n]], pa.string())
    return len(left[-n:].encode()) not in cuts(*flat(near), whole).tolist()


class Sums:
    """A segment tree of whole numbers."""

    def __init__(self, values: list[int]):
        self.size = 1 << max(0, len(values) - 1).bit_length()
        self.node = [0] * self.size + list(values) + [0] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            self.node[i] = self.node[2 * i] + self.node[2 * i + 1]

    @property
    def total(self) -> int:
        return self.node[1]

    def set(self, leaf: int, value: int) -> None:
        i = self.size + leaf
        change = value - self.node[i]
        while i:
            self.node[i] += change
            i >>= 1

    def find(self, place: int) -> tuple[int, int]:
        """The leaf in which a place is, and the place in it; for the end of all, the last leaf that isn't empty."""
        place, i, off = min(place, self.total - 1), 1, max(0, place - (self.total - 1))
        while i < self.size:
            i *= 2
            if place >= self.node[i]:
                place -= self.node[i]
                i += 1
        return i - self.size, place + off


class Tree:
    """A document's leaves with their counts of ids. After edit() the leaves in ``dirty`` wait for counts by put()."""

    def __init__(self, leaves: list[str], counts: list[int], whole: tuple[bytes, ...] = ()):
        self.leaves, self.whole, self.reach = list(leaves) or [""], whole, max([2, *map(len, whole)])
        self.counts, self.lengths = Sums(list(counts) or [0]), Sums([len(x) for x in self.leaves])
        self.dirty: set[int] = set()

    def text(self) -> str:
        return "".join(self.leaves)

    def _hold(self, lo: int, hi: int, text: str) -> None:
        for i in range(lo, hi + 1):
            self.leaves[i] = text if i == lo else ""
            self.lengths.set(i, len(self.leaves[i]))
            self.counts.set(i, 0)
            self.dirty.discard(i)
        if text:
            self.dirty.add(lo)

    def _beside(self, i: int, step: int) -> int | None:
        i += step
        while 0 <= i < len(self.leaves) and not self.leaves[i]:
            i += step
        return i if 0 <= i < len(self.leaves) else None

    def _near(self, i: int | None, step: int) -> str:
        """The text from leaf i on, or up to it, as far as a cut can depend on it."""
        text = ""
        while i is not None and len(text) < self.reach:
            text = text + self.leaves[i] if step > 0 else self.leaves[i] + text
            i = self._beside(i, step)
        return text

    def edit(self, start: int, end: int, new: str) -> None:
        """Puts new in the place of the characters from start to end."""
        if not self.lengths.total:
            return self._hold(0, 0, new)
        lo, a = self.lengths.find(start)
        hi, b = self.lengths.find(end - 1) if end > start else (lo, a - 1)
        text = self.leaves[lo][:a] + new + self.leaves[hi][b + 1 :]
        while True:
            left, right = self._beside(lo, -1), self._beside(hi, 1)
            before, after = self._near(left, -1), self._near(right, 1)
            if not text:
                if left is None or right is None or not joins(before, after, self.whole):
                    break
                lo, text = left, self.leaves[left]
            elif left is not None and joins(before, text + after, self.whole):
                lo, text = left, self.leaves[left] + text
            elif right is not None and joins(before + text, after, self.whole):
                hi, text = right, text + self.leaves[right]
            else:
                break
        self._hold(lo, hi, text)

    def put(self, counts: dict[int, int]) -> None:
        for i, n in counts.items():
            self.counts.set(i, n)
        self.dirty.clear()


def private(text: str) -> list[Edit]:
    """Edits that hide e-mail addresses and long numbers."""
    found = [(*m.span(), "[address]") for m in ADDRESS.finditer(text)] if "@" in text else []
    for m in DIGITS.finditer(text):
        if not any(a < m.end() and m.start() < b for a, b, _ in found):
            found.append((*m.span(), "[number]"))
    return sorted(found)


def _encode_dirty(enc, trees: dict[int, Tree], again: np.ndarray) -> None:
    """Encodes the leaves of all trees that wait for counts, together; again: the characters of each tree that were encoded."""
    waiting = [(i, leaf) for i, t in trees.items() for leaf in sorted(t.dirty)]
    new = enc.counts(pa.array([trees[i].leaves[leaf] for i, leaf in waiting], pa.string())).tolist() if waiting else []
    for (i, leaf), n in zip(waiting, new, strict=True):
        trees[i].put({leaf: n})
        again[i] += len(trees[i].leaves[leaf])


def _count(path: str, edits_of, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, added)
        for batch in chunks(batches, "text", 4 << 20, 2 << 20):
            buf, bounds, first = leaf_bounds(batch.column("text"), whole=enc.whole)
            rows = as_rows(buf, bounds)
            counts = enc.counts(rows) if len(rows) else np.zeros(0, np.int64)
            total = np.r_[0, np.cumsum(counts)]
            before = total[first[1:]] - total[first[:-1]]
            after, n_edits, again = before.copy(), np.zeros(len(before), np.int64), np.zeros(len(before), np.int64)
            trees: dict[int, Tree] = {}
            for i, text in enumerate(batch.column("text").to_pylist()):
                if edits := edits_of(text):
                    trees[i] = Tree(rows[first[i] : first[i + 1]].to_pylist(), counts[first[i] : first[i + 1]].tolist(), enc.whole)
                    for edit in reversed(edits):
                        trees[i].edit(*edit)
                    n_edits[i] = len(edits)
            _encode_dirty(enc, trees, again)
            for i, t in trees.items():
                after[i] = t.counts.total
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in (before, n_edits, after, again))], names=["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_encoded_again"])

    return tidy(run)


def token_counts(docs: DataFrame, tokenizer: str, edits_of=private, added: bool = False) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_edited, n_chars_encoded_again) of each row of docs. added: as for Encoder."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_count(tokenizer, edits_of, added), f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, n_edits long, n_tokens_edited long, n_chars_encoded_again long")


TREE = "lengths array<int>, counts array<int>"


def _ints(rows: list[list[int]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int32()))


def _trees(path: str, added: bool, keep: tuple[str, ...] = ("doc_id", "text")):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, added)
        for batch in chunks(batches, "text", 1 << 20, 1 << 20):
            buf, bounds, first = leaf_bounds(batch.column("text"), whole=enc.whole)
            rows = as_rows(buf, bounds)
            counts = enc.counts(rows).tolist() if len(rows) else []
            lengths = pa.compute.utf8_length(rows).to_pylist()
            cut = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), _ints([lengths[a:b] for a, b in cut]), _ints([counts[a:b] for a, b in cut])], names=[*keep, "lengths", "counts"])

    return tidy(run)


def token_trees(docs: DataFrame, tokenizer: str, added: bool = False) -> DataFrame:
    """(doc_id, text, lengths, counts): each document with the leaves of its tree, by their characters and ids. Written, it is what later
    edits start from; the sums above the leaves follow from them."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_trees(tokenizer, added), f"doc_id {dict(docs.dtypes)['doc_id']}, text string, {TREE}")


def _apply(path: str, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, added)
        for batch in chunks(batches, "text", 1 << 20, 1 << 20):
            trees, again = {}, np.zeros(batch.num_rows, np.int64)
            for i, (text, lengths, counts, edits) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", "lengths", "counts", "edits")), strict=True)):
                at = np.r_[0, np.cumsum(lengths)].astype(int).tolist()
                trees[i] = Tree([text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], counts, enc.whole)
                for e in sorted(edits or [], key=lambda e: (e["start"], e["end"]), reverse=True):
                    trees[i].edit(e["start"], e["end"], e["new"])
            _encode_dirty(enc, trees, again)
            own = [[(len(x), n) for x, n in zip(t.leaves, t.counts.node[t.counts.size :], strict=False) if x] for t in trees.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t.text() for t in trees.values()], pa.string()), _ints([[n for n, _ in x] for x in own]), _ints([[n for _, n in x] for x in own]), pa.array([t.counts.total for t in trees.values()], pa.int64()), pa.array(again)],
                names=["doc_id", "text", "lengths", "counts", "n_tokens", "n_chars_encoded_again"],
            )

    return tidy(run)


def edited(trees: DataFrame, edits: DataFrame, tokenizer: str, added: bool = False) -> DataFrame:
    """(doc_id, text, lengths, counts, n_tokens, n_chars_encoded_again): trees after edits (doc_id, start, end, new) that don't overlap in
    the text as it was. Only touched leaves are encoded. Edits of one doc_id apply to each of its rows; a document without any stays."""
    each = edits.where("doc_id is not null").groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "new")).alias("edits"))
    met = trees.join(each, "doc_id", "left").select("doc_id", "text", "lengths", "counts", "edits")
    return met.mapInArrow(_apply(tokenizer, added), f"doc_id {dict(trees.dtypes)['doc_id']}, text string, {TREE}, n_tokens long, n_chars_encoded_again long")


EDITS = "array<struct<start: int, end: int, new: string>>"


def _edits(edits_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that have edits, with these."""
        for batch in chunks(batches, "text", 1 << 20, 1 << 20):
            found = [edits_of(text) for text in batch.column("text").to_pylist()]
            some = [i for i, x in enumerate(found) if x]
            if some:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("new", pa.string())]))
                own = pa.array([[{"start": a, "end": b, "new": n} for a, b, n in found[i]] for i in some], kind)
                rows = batch.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), rows.column("text"), own], names=["doc_id", "mark", "text", "edits"])

    return tidy(run)


def counts_from_trees(docs: DataFrame, tokenizer: str, edits_of=private, added: bool = False) -> DataFrame:
    """What token_counts() gives, from kept trees: those of all documents are written, without texts; edits are a table of the documents that have any;
    these meet their trees, and the counts after the edits are those of the updated trees. Rows of one id are told apart by a 64-bit hash of
    their text; equal rows are edited once."""
    small_batches(docs.sparkSession)
    kind, key = dict(docs.dtypes)["doc_id"], ["_id", "mark"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    named = lambda df: df.withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    trees = stored(named(rows.mapInArrow(_trees(tokenizer, added, ("doc_id", "mark", "text")), f"doc_id {kind}, mark long, text string, {TREE}").drop("text")), "trees")
    edits = named(rows.mapInArrow(_edits(edits_of), f"doc_id {kind}, mark long, text string, edits {EDITS}"))
    once = lambda df, *columns: df.groupBy(*key).agg(*[F.first(c).alias(c) for c in columns])
    met = once(edits, "text", "edits").join(once(trees, "lengths", "counts"), key)
    applied = met.select(F.struct(*key, F.size("edits").alias("n_edits")).alias("doc_id"), "text", "lengths", "counts", "edits")
    after = applied.mapInArrow(_apply(tokenizer, added), f"doc_id struct<_id: string, mark: long, n_edits: int>, text string, {TREE}, n_tokens long, n_chars_encoded_again long")
    after = stored(after.select("doc_id.*", F.col("n_tokens").alias("n_tokens_edited"), "n_chars_encoded_again"), "edited")
    out = meet(trees.withColumn("n_tokens", F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).drop("lengths", "counts"), after, key, "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", "n_tokens", F.coalesce(F.col("n_edits").cast("long"), none).alias("n_edits"), F.coalesce("n_tokens_edited", "n_tokens").alias("n_tokens_edited"), F.coalesce("n_chars_encoded_again", none).alias("n_chars_encoded_again"))
