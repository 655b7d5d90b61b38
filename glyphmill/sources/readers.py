"""Scans. A missing cell is an empty string; a file's place is (file, line_no)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.functions.columns import blank, strip

SKIPPED = ("schema", "_60", "mtr")


def stem() -> Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")


def markdown(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, text) of the Markdown files of a folder, but for readme.md."""
    rows = spark.read.text(path, wholetext=True) if str(path).endswith(".md") else spark.read.option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return rows.select(stem().alias("file"), F.col("value").alias("text")).where(F.lower("file") != "readme")


def table(spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None, sep: str = ",", rows: bool = False) -> DataFrame:
    """A CSV table with a header and its file's stem; named columns that it lacks are empty. With rows, also ``row``, a record's number in
    its file; the header is number 1."""
    found = spark.read.csv(path, header=True, sep=sep, escape='"', multiLine=True, enforceSchema=False)
    columns = list(columns or found.columns)
    own = [(blank(F.col(f"`{c}`")) if c in found.columns else F.lit("")).alias(c) for c in columns]
    found = found.select(stem().alias("file"), *own, F.col("_metadata.file_path").alias("__path"), F.monotonically_increasing_id().alias("__id"))
    if rows:
        # Such a file is read by one task, so its numbers follow each other. A row for each file is broadcast.
        first = found.groupBy("__path").agg(F.min("__id").alias("__first"))
        found = found.join(F.broadcast(first), "__path").withColumn("row", F.col("__id") - F.col("__first") + 2)
    return found.select("file", *columns, *(["row"] if rows else []))


def file_lines(spark: SparkSession, path: str | list[str], marked: Column | None = None, **options: str) -> DataFrame:
    """(file, line_no, line) of text files, which are read in splits. With a condition, also ``first``: the number of the first line of its file
    that fulfils it. Lines are numbered by counts of the splits before theirs; a row for each split, so for each task, meets the lines again."""
    lines = spark.read.options(**options).option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    mark = F.lit(None).cast("long") if marked is None else F.when(marked, F.col("id"))
    splits = lines.groupBy("path", "block").agg(F.min("id").alias("start"), F.count("*").alias("n"), F.min(mark).alias("mark"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("before", before).withColumn("first", F.min(F.col("before") + F.col("mark") - F.col("start")).over(W.partitionBy("path")))
    met = lines.join(F.broadcast(splits.select("path", "block", "start", "before", "first")), ["path", "block"])
    return met.select("file", (F.col("before") + F.col("id") - F.col("start")).alias("line_no"), "line", *([] if marked is None else ["first"]))


def dictionary(spark: SparkSession, path: str | list[str], fields: int = 2) -> DataFrame:
    """(file, line_no, text, code[, weight]) of dictionary files: after a line ``...``, lines of so many fields parted by tabs."""
    rows = file_lines(spark, path, strip(F.col("line")) == "...", recursiveFileLookup="true")
    rows = rows.where(~F.exists(F.array(*map(F.lit, SKIPPED)), lambda s: F.contains("file", s)))
    rows = rows.where("line_no > first and line <> '' and not startswith(line, '#')").withColumn("f", F.split("line", "\t", -1)).where(F.size("f") == fields)
    rows = rows.select("file", F.col("line_no").cast("int").alias("line_no"), strip(F.get("f", F.lit(0))).alias("text"), strip(F.get("f", F.lit(1))).alias("code"), *([F.get("f", F.lit(2)).cast("int").alias("weight")] if fields > 2 else []))
    return rows.where("text <> ''")


def variants_of(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The table of character variants: small by nature (a spelling rule each), so it becomes part of the plan."""
    rows = table(spark, path, ["recommend", "variant_1", "variant_2", "variant_3"]).collect()
    found = {r["recommend"].strip(): [v for k in (1, 2, 3) if (v := r[f"variant_{k}"].strip())] for r in rows}
    return {k: v for k, v in found.items() if k and v}


def words_of(spark: SparkSession, path: str) -> list[str]:
    return sorted({r["word"].strip() for r in table(spark, path, ["word"]).collect() if r["word"].strip()})
