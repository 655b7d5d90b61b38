"""Segmentation of what was typed in one run: the spans that dictionary codes take, and the best way to part it into codes.

Spans: runs of letters meet codes by equality: each run is taken once, however often it was typed, and gives a row for each place and length, to the
longest code. The best parting needs no row for most spans: a bounded number of codes, the shortest and of the others the heaviest, goes to all tasks; of the rest
only the places that the bits of operators/places.py leave meet the codes, by equality. Many runs at a time are parted from their ends by dynamic
programming: for every place the best way from there, from those of the places after it. Memory follows the letters of a batch times the longest code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.operators.places import Hashes, possible
from glyphmill.sources.shared import kept

#: The most codes that go to all tasks, half of them as the shortest.
FEW = 200_000


def spans(typed: DataFrame, codes: DataFrame, longest: int) -> DataFrame:
    """(typed, start, length, weight): where distinct codes (code, weight) of so many letters at most stand in distinct runs (typed)."""
    runs = typed.select("typed").where("typed <> ''").distinct()
    starts = runs.select("typed", F.explode(F.sequence(F.lit(1), F.length("typed"))).alias("at"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("typed") - F.col("at") + 1))
    places = starts.select("typed", "at", F.explode(lengths).alias("length"))
    places = places.select("typed", (F.col("at") - 1).alias("start"), "length", F.substring("typed", F.col("at"), F.col("length")).alias("code"))
    best = codes.where((F.length("code") <= longest) & (F.col("code") != "")).groupBy("code").agg(F.max("weight").alias("weight"))
    return places.join(best, "code").select("typed", "start", "length", "weight")


class Codes:
    """Weights of a bounded number of codes, looked up for many parts of strings at once: by hash, then compared letter by letter."""

    def __init__(self, codes: list[str], weights: list[int]):
        size = np.array([len(c) for c in codes], "i8")
        begin = np.cumsum(size) - size
        own = Hashes(codes)
        hashes = own.of(begin, begin + size)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.size, self.begin, self.weights = hashes[order], size[order], begin[order], np.array(weights, "i8")[order]
        self.letters, self.lengths = own.letters, np.unique(size).tolist()
        # Most parts are no code: a bit for the top of each hash tells so first.
        self.seen = np.zeros(1 << 22, bool)
        self.seen[hashes >> np.uint64(42)] = True

    def at(self, text: Hashes, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of the places where a code of k letters begins, and its weights."""
        hashes = text.of(at, at + k)
        maybe = self.seen[hashes >> np.uint64(42)]
        at, hashes = at[maybe], hashes[maybe]
        first = np.searchsorted(self.hashes, hashes)
        found, weights = np.zeros(len(at), bool), np.zeros(len(at), "i8")
        for step in range(len(self.hashes)):  # codes of the same hash stand side by side
            i = np.minimum(first + step, len(self.hashes) - 1)
            same = (first + step < len(self.hashes)) & (self.hashes[i] == hashes)
            if not same.any():
                break
            fits = same & (self.size[i] == k)
            for j in range(k):
                some = np.flatnonzero(fits)
                fits[some] = self.letters[self.begin[i[some]] + j] == text.letters[at[some] + j]
            found |= fits
            weights[fits] = self.weights[i[fits]]
        return at[found], weights[found]


def _parted(runs: list[str], codes: Codes, far: list[tuple[int, int, int, int]], longest: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The best way along each run. Letters in no word count as unknown, each a part of its own. far: (row, start, length, weight) of more codes.
    Returns unknown, words and weight of each run, then the number of parts and all parts' lengths."""
    size = np.array([len(r) for r in runs], "i8")
    ends = np.cumsum(size)
    text = Hashes(runs)
    left = np.repeat(ends, size) - np.arange(text.n)
    has, weight = np.zeros((longest + 1, text.n), bool), np.zeros((longest + 1, text.n), "i8")
    for k in codes.lengths:
        at, found = codes.at(text, np.flatnonzero(left >= k), k)
        has[k, at], weight[k, at] = True, found
    if far:
        row, start, length, more = np.array(far, "i8").T
        has[length, ends[row] - size[row] + start], weight[length, ends[row] - size[row] + start] = True, more
    # A run has a place more than letters: place i of a row stands at i plus the letters and rows before it.
    order = np.argsort(-size, kind="stable")
    last, letters = (ends + np.arange(len(runs)))[order], ends[order]
    rest = -np.sort(-size)
    unknown, words, heavy, taken = (np.zeros(text.n + len(runs), "i8") for _ in range(4))
    for r in range(1, int(rest[0]) + 1 if len(rest) else 0):
        n = np.searchsorted(-rest, -r, side="right")
        place, letter = last[:n] - r, letters[:n] - r
        u, k, w, x = unknown[place + 1] + 1, words[place + 1] + 1, heavy[place + 1].copy(), np.ones(n, "i8")
        for length in range(1, min(r, longest) + 1):
            some = np.flatnonzero(has[length, letter])
            to = place[some] + length
            v, j, z = unknown[to], words[to] + 1, heavy[to] + weight[length, letter[some]]
            better = (v < u[some]) | (v == u[some]) & ((j < k[some]) | (j == k[some]) & (z > w[some]))
            put = some[better]
            u[put], k[put], w[put], x[put] = v[better], j[better], z[better], length
        unknown[place], words[place], heavy[place], taken[place] = u, k, w, x
    first = ends - size + np.arange(len(runs))
    parts = words[first]
    lengths, offset = np.zeros(int(parts.sum()), "i8"), np.cumsum(parts) - parts
    rows, at = np.flatnonzero(parts > 0), first[parts > 0]
    for step in range(int(parts.max()) if len(parts) else 0):
        lengths[offset[rows] + step] = taken[at]
        at = at + taken[at]
        more = parts[rows] > step + 1
        rows, at = rows[more], at[more]
    return [unknown[first], parts, heavy[first]], parts, lengths


def _near_and_rest(codes: DataFrame, longest: int) -> tuple[Broadcast, DataFrame]:
    """A bounded number of distinct codes and their weights for all tasks, the shortest and of the others the heaviest; the rest as (key, weight)."""
    spark = codes.sparkSession
    best = codes.where((F.length("code") <= longest) & (F.col("code") != "")).groupBy(F.col("code").alias("key")).agg(F.coalesce(F.max("weight"), F.lit(0)).cast("bigint").alias("weight"))
    best = kept(best.withColumn("size", F.length("key")), "codes")
    most = few = 0
    for r in best.groupBy("size").count().orderBy("size").collect():
        if few + r["count"] > FEW // 2:
            break
        most, few = r["size"], few + r["count"]
    step = F.floor(F.log2(F.greatest(F.col("weight"), F.lit(1)))).cast("int")
    heavy = 64
    for r in best.where(F.col("size") > most).groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if few + r["count"] > FEW:
            break
        heavy, few = r["step"], few + r["count"]
    near = (F.col("size") <= most) | (step >= heavy)
    table = best.where(near).toArrow()
    known = spark.sparkContext.broadcast((table.column("key").to_pylist(), table.column("weight").to_pylist()))
    return known, best.where(~near).select("key", "weight")


def beginnings(typed: DataFrame, codes: DataFrame, longest: int) -> DataFrame:
    """(typed, start, length, weight): what spans() gives at start 0, without a row for each length that a run might begin with. A null weight counts as 0."""
    known, rest = _near_and_rest(codes, longest)
    runs = typed.select("typed").where("typed <> ''").distinct()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = Codes(*known.value)
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(0).to_pylist()
            size = np.array([len(t) for t in texts], "i8")
            first = np.cumsum(size) - size
            text = Hashes(texts)
            for k in short.lengths:
                at, weights = short.at(text, first[size >= k], k)
                own = b.column(0).take(pa.array(np.searchsorted(first, at)))
                yield pa.RecordBatch.from_arrays([own, pa.array(np.zeros(len(at), "i4")), pa.array(np.full(len(at), k, "i4")), pa.array(weights)], ["typed", "start", "length", "weight"])

    near = runs.mapInArrow(begin, "typed string, start int, length int, weight long")
    far = possible(runs.select(F.col("typed").alias("id"), F.col("typed").alias("text")), rest, first=True).join(rest, "key")
    return near.unionByName(far.select(F.col("id").alias("typed"), "start", "length", "weight"))


def segmented(typed: DataFrame, codes: DataFrame, longest: int = 16) -> DataFrame:
    """(typed, pieces, unknown, words, weight) of each distinct run: the parting with fewest letters outside of codes, then fewest parts, then
    the largest sum of weights, then the shortest parts first. A null or empty run gives no row; a null weight counts as 0."""
    known, rest = _near_and_rest(codes, longest)
    runs = typed.select("typed").where("typed <> ''").distinct()
    far = possible(runs.select(F.col("typed").alias("id"), F.col("typed").alias("text")), rest).join(rest, "key")
    far = far.groupBy(F.col("id").alias("typed")).agg(F.collect_list(F.struct("start", "length", "weight")).alias("far"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = Codes(*known.value)
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column(0).to_pylist()
            more = [(row, x["start"], x["length"], x["weight"]) for row, found in enumerate(b.column(1).to_pylist()) for x in found or ()]
            (unknown, words, weight), parts, lengths = _parted(texts, short, more, longest)
            every, stops = "".join(texts), np.cumsum(lengths).tolist()
            pieces = pa.array([every[a:z] for a, z in zip([0, *stops], stops)], pa.string())
            cuts = pa.array(np.concatenate(([0], np.cumsum(parts))).astype("i4"))
            out = [b.column(0), pa.ListArray.from_arrays(cuts, pieces), pa.array(unknown.astype("i4")), pa.array(words.astype("i4")), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(out, ["typed", "pieces", "unknown", "words", "weight"])

    return runs.join(far, "typed", "left").mapInArrow(part, "typed string, pieces array<string>, unknown int, words int, weight long")


def candidate_spans(typed: DataFrame, dictionary: DataFrame, longest: int = 16) -> DataFrame:
    """(typed, text, code, weight, span): entries (text, code, weight) whose code, without spaces, begins a run, with the letters that it takes; the input
    of lookup.candidates()."""
    entries = dictionary.withColumn("_run", F.replace("code", F.lit(" "), F.lit("")))
    known = entries.select(F.col("_run").alias("code"), F.lit(0).alias("weight"))
    first = spans(typed, known, longest).where("start = 0").select("typed", F.substring("typed", F.lit(1), F.col("length")).alias("_run"), F.col("length").alias("span"))
    return first.join(entries, "_run").select("typed", "text", "code", "weight", "span")
