"""Benchmark decontamination: a positional inverted index of the training words, asked for the phrases of benchmark items.

The index is written to the shared folder once, in segments of some documents each: a segment has its terms in order (hashes), how many
places each has, and the places, which ascend for each term; and its documents with the place where each begins. Any number of benchmarks
and blocks are asked of it, none of which reads a text again.

A question first sums how often each benchmark term occurs in all segments. Each segment then drops phrases one of whose terms it lacks
and asks for the others from their rarest term on: that term's places, moved back by its offset, are intersected with those of the next
rarest, moved back by theirs, and so on until all words agree. With slop > 0 a phrase is also matched where all its words lie within
``window + slop`` words in any order (proximity): there the lists are intersected by reach first, and what is left is looked at closely.

The phrases are put together in arrays, at most ``most_bytes`` of them at once; a larger benchmark is cut into blocks below that size, an
item of very many words into pieces that overlap. Blocks are asked one after another, and only hits are put together afterwards.

Defined cases: a null or empty text has no words and no hits; an item without words is never found; equal windows of several items
count for each. Items with equal ids count once. Repeated rows get equal results. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._words import NOT_ALNUM, Words, chunks, tidy
from glyphmill.llm._work import LARGE_ROWS, drop_stored, only, small_batches, stored

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PIECE_WORDS = 50_000
SEGMENT = "ids array<{0}>, rows binary, first binary, terms binary, count binary, places binary"


@dataclass
class Phrases:
    """The windows of a block of benchmark items. Rows of ``numbers`` are windows, each word by its number among ``terms``, of ``length``
    words, padded with 0; the items of window i are names[items[at[i]:at[i + 1]]]; ``names`` ascends."""

    numbers: np.ndarray
    length: np.ndarray
    names: list[str]
    items: np.ndarray
    at: np.ndarray
    terms: np.ndarray

    @staticmethod
    def of(rows: list[tuple[str, str]], window: int) -> Phrases:
        words = Words(pa.array([t or "" for _, t in rows], pa.string()), NOT_ALNUM, fold=True)
        terms, number = np.unique(words.hash, return_inverse=True)
        names = sorted({item for item, _ in rows})
        place = {n: i for i, n in enumerate(names)}
        n = words.counts()
        many = np.where(n > 0, np.maximum(1, n - window + 1), 0)
        row = np.repeat(np.arange(len(rows)), many)
        start = words.first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        length = np.minimum(n[row], window)
        table = np.full((len(row), window), -1, np.int32)
        for j in range(window):
            table[length > j, j] = number[start[length > j] + j]
        if not len(row):
            return Phrases(table, length, names, np.zeros(0, np.int32), np.zeros(1, np.int64), terms)
        kinds, of = np.unique(table.view(f"V{4 * window}").ravel(), return_inverse=True)
        pairs = np.unique(np.stack([of.ravel(), np.array([place[item] for item, _ in rows])[row]], 1), axis=0)
        table = kinds.view(np.int32).reshape(-1, window)
        return Phrases(np.maximum(table, 0), (table >= 0).sum(axis=1), names, pairs[:, 1].astype(np.int32), np.searchsorted(pairs[:, 0], np.arange(len(kinds) + 1)), terms)

    def by_rarity(self, seen: np.ndarray) -> np.ndarray:
        """For each window its offsets, the rarest term first; seen: how often each of terms occurs."""
        count = seen[self.numbers]
        count[np.arange(self.numbers.shape[1]) >= self.length[:, None]] = np.iinfo(np.int64).max
        return np.argsort(count, axis=1, kind="stable").astype(np.int8 if self.numbers.shape[1] < 128 else np.int32)

    def all_in(self, slots: np.ndarray) -> np.ndarray:
        """The windows all of whose terms have a slot."""
        return np.flatnonzero(((slots[self.numbers] >= 0) | (np.arange(self.numbers.shape[1]) >= self.length[:, None])).all(axis=1))

    def items_of(self, windows: np.ndarray) -> list[str]:
        found = {int(i) for w in windows.tolist() for i in self.items[self.at[w] : self.at[w + 1]]}
        return [self.names[i] for i in sorted(found)]


@dataclass
class Segment:
    """Documents and postings of one row of the index."""

    first: np.ndarray
    terms: np.ndarray
    begin: np.ndarray
    count: np.ndarray
    places: np.ndarray

    @staticmethod
    def of(row: dict) -> Segment:
        count = np.frombuffer(row["count"], np.int32).astype(np.int64)
        return Segment(np.frombuffer(row["first"], np.int64), np.frombuffer(row["terms"], np.uint64), np.cumsum(count) - count, count, np.frombuffer(row["places"], np.int32).astype(np.int64))

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term here, -1 for those that the segment lacks."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.searchsorted(self.terms, terms).clip(0, len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


def index(docs: DataFrame) -> DataFrame:
    """The index of docs, written to the shared folder."""
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("row"), text.alias("text"))
    return stored(rows.mapInArrow(_segments, SEGMENT.format(kind)), "index", **LARGE_ROWS)


@tidy
def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text", 1 << 20, 1 << 20):
        if not batch.num_rows:
            continue
        words = Words(batch.column("text"), NOT_ALNUM, fold=True)
        order = np.argsort(words.hash, kind="stable")
        value = words.hash[order]
        at = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else np.zeros(0, np.int64)
        count = np.diff(np.r_[at, len(value)]).astype(np.int32)
        ids = batch.column("doc_id")
        parts = (batch.column("row").to_numpy(), words.first.astype(np.int64), value[at], count, order.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["ids", "rows", "first", "terms", "count", "places"])


def _search(seg: Segment, phrases: Phrases, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, number of the window) of each exact match within one document."""
    none = np.zeros(0, np.int64)
    if not len(seg.places) or not len(phrases.length):
        return none, none
    slots = seg.slots(phrases.terms)
    asked, numbers = phrases.all_in(slots), phrases.numbers
    if not len(asked):
        return none, none
    stride = np.int64(len(seg.places) + numbers.shape[1] + 1)
    postings = np.repeat(np.arange(len(seg.terms)), seg.count) * stride + seg.places
    rarest = slots[numbers[asked, order[asked, 0]]]
    many = seg.count[rarest]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for lo, hi in _blocks(many, 1 << 17):
        window = np.repeat(asked[lo:hi], many[lo:hi])
        inner = np.arange(len(window)) - np.repeat(np.cumsum(many[lo:hi]) - many[lo:hi], many[lo:hi])
        hit = seg.places[np.repeat(seg.begin[rarest[lo:hi]], many[lo:hi]) + inner]
        doc = np.searchsorted(seg.first, hit, "right") - 1
        first = hit - order[window, 0]
        good = (first >= seg.first[doc]) & (first + phrases.length[window] <= seg.first[doc + 1])
        first, window = first[good], window[good]
        for j in range(1, order.shape[1]):
            if not len(window):
                break
            off = order[window, j].astype(np.int64)
            want = slots[numbers[window, off]] * stride + first + off
            at = np.searchsorted(postings, want).clip(0, len(postings) - 1)
            agree = (off >= phrases.length[window]) | (postings[at] == want)
            first, window = first[agree], window[agree]
        found.append((first, window))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _near(seg: Segment, phrases: Phrases, order: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, window) of the first span from each place of a rarest term in which all words of the window
    lie."""
    out: list[tuple[int, int, int]] = []
    if len(seg.places) and len(phrases.length):
        slots = seg.slots(phrases.terms)
        of = lambda t: seg.places[seg.begin[t] : seg.begin[t] + seg.count[t]]
        for w in phrases.all_in(slots).tolist():
            length = int(phrases.length[w])
            reach, need = length + slop, slots[phrases.numbers[w, order[w, :length]]]
            hit = of(need[0])
            doc = np.searchsorted(seg.first, hit, "right") - 1
            low, high = np.maximum(seg.first[doc], hit - reach + 1), np.minimum(seg.first[doc + 1], hit + reach)
            for t in need[1:]:
                own = of(t)
                at = np.searchsorted(own, low)
                keep = (at < len(own)) & (own[np.minimum(at, len(own) - 1)] < high)
                hit, low, high, doc = hit[keep], low[keep], high[keep], doc[keep]
            kinds, least = np.unique(need, return_counts=True)
            for h, lo0, end in zip(hit.tolist(), low.tolist(), seg.first[doc + 1].tolist(), strict=True):
                lo = np.arange(lo0, h + 1)
                hi = np.minimum(lo + reach, end)
                fit = np.ones(len(lo), bool)
                for t, n in zip(kinds, least, strict=True):
                    own = of(t)
                    fit &= np.searchsorted(own, hi) - np.searchsorted(own, lo) >= n
                if fit.any():
                    i = int(np.argmax(fit))
                    out.append((int(lo[i]), int(hi[i]), w))
    return tuple(np.array(x, np.int64) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def _blocks(many: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of windows with about ``most`` candidates each, so memory is bounded."""
    total, lo = np.cumsum(many), 0
    while lo < len(many):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + most, "right")))
        yield lo, hi
        lo = hi


def _count(asked):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = asked.value
        seen = np.zeros(len(terms), np.int64)
        for batch in batches:
            for own, count in zip(batch.column("terms").to_pylist(), batch.column("count").to_pylist(), strict=True):
                own, count = np.frombuffer(own, np.uint64), np.frombuffer(count, np.int32)
                at = np.searchsorted(terms, own).clip(0, len(terms) - 1)
                met = terms[at] == own
                seen[at[met]] += count[met]
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["term", "seen"])

    return tidy(run)


def _covered(first: np.ndarray, last: np.ndarray, n: int) -> int:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:n] > 0))


def _digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()


def _hits(asked, slop: int) -> Iterator[tuple]:
    """For each row of the index: its ids and row hashes, words of each document, and (document, first, last, window, exact) of the hits."""
    phrases, order = asked.value

    def of(batch: pa.RecordBatch):
        for i, row in enumerate(batch.select(["rows", "first", "terms", "count", "places"]).to_pylist()):
            seg = Segment.of(row)
            first, window = _search(seg, phrases, order)
            last, exact = first + phrases.length[window], np.ones(len(first), bool)
            if slop:
                a, b, near = _near(seg, phrases, order, slop)
                first, last, window, exact = np.r_[first, a], np.r_[last, b], np.r_[window, near], np.r_[exact, np.zeros(len(a), bool)]
            doc = np.searchsorted(seg.first, first, "right") - 1
            by = np.argsort(doc, kind="stable")
            doc = doc[by]
            begin = seg.first[doc]
            yield batch.column("ids")[i].values, np.frombuffer(row["rows"], np.int64), np.diff(seg.first), (doc, first[by] - begin, last[by] - begin, window[by], exact[by])

    return phrases, of


NAMES = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _found(asked, slop: int):
    """The result of each document, where one block is the whole benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, of = _hits(asked, slop)
        empty = _digest([])
        for batch in batches:
            for ids, _, n, (doc, first, last, window, _) in of(batch):
                hits, items, digests = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), [empty] * len(ids)
                for d in np.unique(doc).tolist():
                    lo, hi = np.searchsorted(doc, [d, d + 1])
                    names = phrases.items_of(np.unique(window[lo:hi]))
                    hits[d], items[d], digests[d] = _covered(first[lo:hi], last[lo:hi], int(n[d])), len(names), _digest(names)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(hits), pa.array(items), pa.array(digests, pa.string()), pa.array(hits > 0)], names=NAMES)

    return tidy(run)


def _some(asked, slop: int):
    """Documents with hits only: their spans and items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, of = _hits(asked, slop)
        for batch in batches:
            for ids, rows, _, (doc, first, last, window, _) in of(batch):
                own = np.unique(doc)
                cut = [np.searchsorted(doc, [d, d + 1]) for d in own.tolist()]
                spans = [np.stack([first[a:b], last[a:b]], 1).tobytes() for a, b in cut]
                items = [phrases.items_of(np.unique(window[a:b])) for a, b in cut]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(own)), pa.array(rows[own]), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))], names=["doc_id", "row", "spans", "items"])

    return tidy(run)


def _matches(asked, slop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, of = _hits(asked, slop)
        for batch in batches:
            for ids, _, _, (doc, first, last, window, exact) in of(batch):
                keep = exact.copy()
                for i in np.flatnonzero(~exact).tolist():
                    # A near match counts unless an exact one of its window lies within it.
                    inside = exact & (doc == doc[i]) & (window == window[i]) & (first >= first[i]) & (last <= last[i])
                    keep[i] = not inside.any()
                doc, first, last, window, exact = (x[keep] for x in (doc, first, last, window, exact))
                many = phrases.at[window + 1] - phrases.at[window]
                items = [phrases.names[i] for w in window.tolist() for i in phrases.items[phrases.at[w] : phrases.at[w + 1]]]
                doc, first, last, exact = (np.repeat(x, many) for x in (doc, first, last, exact))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), pa.array(items, pa.string()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(exact)], names=["doc_id", "item_id", "first", "last", "exact"])

    return tidy(run)


@tidy
def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits, items, digests = [], [], []
        for spans, own, n in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), batch.column("n_words").to_pylist(), strict=True):
            names = sorted({x for some in own or [] for x in some})
            cut = np.frombuffer(b"".join(spans or []), np.int64).reshape(-1, 2)
            hits.append(_covered(cut[:, 0], cut[:, 1], n))
            items.append(len(names))
            digests.append(_digest(names))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(hits, pa.int64()), pa.array(items, pa.int64()), pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_())], names=NAMES)


def _passes(segments: DataFrame, bench: DataFrame, window: int, most_bytes: int) -> Iterator[tuple[int, object]]:
    """(number of blocks, broadcast of a block's phrases and their offsets by rarity)."""
    context = segments.sparkSession.sparkContext
    items = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("text"))
    items = items.withColumn("n", F.regexp_count("text", F.lit(WORD)))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    last = F.greatest(F.col("n") - window, F.lit(0))
    pieces = F.transform(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS)), lambda i: F.array_join(F.slice(words, i + 1, PIECE_WORDS + window - 1), " "))
    items = items.select("item", F.explode(F.when(F.col("n") > PIECE_WORDS, pieces).otherwise(F.array("text"))).alias("text")).withColumn("n", F.regexp_count("text", F.lit(WORD)))
    size = (items.agg(F.sum(F.col("n") + 1)).first()[0] or 0) * (6 * window + 24)
    blocks = 1 if size <= most_bytes else -(-5 * size // (4 * most_bytes))
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        phrases = Phrases.of([(r["item"], r["text"]) for r in own.select("item", "text").collect()], window)
        order = np.zeros((0, window), np.int8)
        if len(phrases.terms):
            seen = np.zeros(len(phrases.terms), np.int64)
            counted = segments.select("terms", "count").mapInArrow(_count(context.broadcast(phrases.terms)), "term long, seen long").groupBy("term").agg(F.sum("seen").alias("seen"))
            for r in counted.collect():
                seen[r["term"]] = r["seen"]
            order = phrases.by_rarity(seen)
        yield blocks, context.broadcast((phrases, order))


def _kind(segments: DataFrame) -> str:
    return dict(segments.dtypes)["ids"].removeprefix("array<").removesuffix(">")


def _with_hits(segments: DataFrame, bench: DataFrame, window: int, slop: int, most_bytes: int) -> tuple[DataFrame | None, list]:
    """(hits of all blocks put together, None), or (None, the block) if there is one only."""
    schema, parts = f"doc_id {_kind(segments)}, row long, spans binary, items array<string>", None
    for blocks, asked in _passes(segments, bench, window, most_bytes):
        if blocks == 1:
            return None, asked
        # Each block's hits are written before the next one's phrases take its place.
        some = stored(segments.mapInArrow(_some(asked, slop), schema), "hits")
        asked.destroy()
        parts = some if parts is None else parts.unionByName(some)
    return parts, None


def find_leaks(docs: DataFrame, bench: DataFrame, window: int = 10, slop: int = 0, most_bytes: int = 48 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of docs."""
    segments = index(docs)
    result = f"doc_id {_kind(segments)}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    hits, asked = _with_hits(segments, bench, window, slop, most_bytes)
    if asked is not None:
        return segments.mapInArrow(_found(asked, slop), result)
    each = hits.groupBy("doc_id", "row").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items")).withColumnsRenamed({"doc_id": "hit_id", "row": "hit_row"})
    every = segments.select("ids", "rows", "first").mapInArrow(_sizes, f"doc_id {_kind(segments)}, row long, n_words long")
    met = every.join(F.broadcast(each) if each.count() <= 1000 else each, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("row") == F.col("hit_row")), "left")
    return met.select("doc_id", "n_words", "spans", "items").mapInArrow(_merge, result)


@tidy
def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows, first = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("rows", "first"))
            yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(rows), pa.array(np.diff(first))], names=["doc_id", "row", "n_words"])


def leak_matches(docs: DataFrame, bench: DataFrame, window: int = 10, slop: int = 0, most_bytes: int = 48 << 20) -> DataFrame:
    """(doc_id, item_id as text, first, last, exact): each place where a window of an item occurs, as the number of its first word in
    the document and of the word after its last. exact: word for word; else near, in a span that holds no exact match of the window."""
    segments, parts = index(docs), None
    for _, asked in _passes(segments, bench, window, most_bytes):
        found = segments.mapInArrow(_matches(asked, slop), f"doc_id {_kind(segments)}, item_id string, first long, last long, exact boolean")
        parts = found if parts is None else parts.unionByName(found)
    return parts


def drop_leaks(docs: DataFrame, bench: DataFrame, window: int = 10, most_bytes: int = 48 << 20) -> DataFrame:
    """The rows of docs in which no window of an item occurs, with the columns of docs."""
    segments = index(docs)
    hits, asked = _with_hits(segments, bench, window, 0, most_bytes)
    if asked is not None:
        hits = segments.mapInArrow(_some(asked, 0), f"doc_id {_kind(segments)}, row long, spans binary, items array<string>")
    keys = [F.col("doc_id").isNull().alias("key_none"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key_id")]
    gone = stored(hits.select(*keys, F.col("row").alias("key_row")).distinct(), "leaks")
    drop_stored(segments)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys, F.xxhash64(F.coalesce("text", F.lit(""))).alias("key_row"))
    return only(rows, gone, ["key_none", "key_id", "key_row"], "left_anti").select("row.*")
