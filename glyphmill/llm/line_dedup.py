"""Line dedup: runs of lines that repeat an earlier run are deleted, the first run stays.

Only DataFrame operations. A line here is one that holds a word; documents are ordered by doc_id, lines by place. A line is deleted
if it lies in a window of ``run`` consecutive lines whose content starts at an earlier place too (in an earlier document or earlier in
its own); overlapping windows make up maximal runs. A document of fewer lines than ``run`` has no window.

Winnowing: the smallest line hash of each window is its fingerprint, so equal windows share it for sure. Only fingerprints are
stored, a row each, fewer than lines: the place, and the matches that can be extended from it, which are the windows to its left and right
whose smallest line it is, by two 64-bit hashes of all their lines. Fingerprints that occur at one place only end the matter. At the
others positions are joined by the extended content, and all but its first place are deleted; where matches go on beyond a window the
next fingerprint takes over, so runs are maximal. Nothing is paired: places meet in minima with map-side combine. A fingerprint or a
window with over a thousandth of all rows (a very common line) meets its one row by broadcast, the others by a shuffle.

Defined cases: a null or empty text has no lines. A null doc_id comes after all others. Equal doc_ids are ordered by a hash of their
texts; equal rows get equal results. Lines without a word stay. Other columns are kept, under any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._work import let, meet, stored

WORD = r"[^\x20\x09-\x0D]"


def _windows(hashes: Column, run: int) -> Column:
    """hashes: array of (a, b) for each line. An array of (at, print_at, print, a, b), one for each window."""

    def of(x: Column, i: Column) -> Column:
        part = F.slice(x, i + 1, run)
        low = F.array_min(F.transform(part, lambda h: h["a"]))
        place = i + F.array_position(F.transform(part, lambda h: h["a"]), low).cast("int") - 1
        return F.struct(i.alias("at"), place.alias("print_at"), low.alias("print"), F.xxhash64(F.transform(part, lambda h: h["a"])).alias("a"), F.xxhash64(F.transform(part, lambda h: h["b"])).alias("b"))

    def all_of(x: Column) -> Column:
        return F.transform(F.when(F.size(x) >= run, F.sequence(F.lit(0), F.size(x) - run)).otherwise(F.array().cast("array<int>")), lambda i: of(x, i))

    return let(hashes, all_of)


def _prints(windows: Column, run: int) -> Column:
    """An array of (print_at, print, matches: the windows (at, a, b) whose fingerprint it is), one for each fingerprint."""

    def of(x: Column, p: Column) -> Column:
        own = F.filter(F.slice(x, F.greatest(p - run + 1, F.lit(0)) + 1, run), lambda w: w["print_at"] == p)
        return let(own, lambda ws: F.struct(p.alias("print_at"), F.get(ws, F.lit(0))["print"].alias("print"), F.transform(ws, lambda w: F.struct(w["at"].alias("at"), w["a"].alias("a"), w["b"].alias("b"))).alias("matches")))

    return let(windows, lambda x: F.transform(F.array_distinct(F.transform(x, lambda w: w["print_at"])), lambda p: of(x, p)))


def line_dedup(docs: DataFrame, run: int = 3) -> DataFrame:
    """(row: the columns of docs, n_lines, n_removed, kept: the text left)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash")).alias("doc"), F.coalesce("text", F.lit("")).alias("body"))
    lines = F.filter(F.split("body", "\n", -1), lambda x: x.rlike(WORD))
    hashes = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))
    prints = stored(rows.select("doc", F.inline(_prints(_windows(hashes, run), run))), "prints")

    again = prints.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    found = stored(meet(prints, again, "print").select("doc", F.inline("matches")), "matches")
    place = F.struct("doc", "at")
    first = found.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("a", "b", "first")
    later = meet(found, first, ["a", "b"]).where(place > F.col("first")).select("doc", "at")
    gone = later.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("gone"))

    met = rows.join(gone, "doc", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    marked = F.array_distinct(F.flatten(F.transform("gone", lambda i: F.sequence(i, i + run - 1))))
    every = F.split("body", "\n", -1)
    own = F.filter(F.transform(every, lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())
    parts = F.array(F.struct(every.alias("every"), own.alias("own"), marked.alias("marked")))

    def result(x: Column) -> Column:
        cut = F.transform(x["marked"], lambda m: F.get(x["own"], m))
        stay = F.array_except(F.sequence(F.lit(0), F.size(x["every"]) - 1), cut)
        return F.struct(F.size(x["own"]).cast("long").alias("n_lines"), F.size(x["marked"]).cast("long").alias("n_removed"), F.array_join(F.transform(stay, lambda i: F.get(x["every"], i)), "\n").alias("kept"))

    return met.select("row", F.inline(F.transform(parts, result)))
