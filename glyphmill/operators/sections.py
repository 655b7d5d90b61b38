"""Books cut at their headings: sections, chapters and their numbers, file names and index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.functions.columns import blank, strip


def sections(lines: DataFrame, level: int) -> DataFrame:
    """(file, section_no, title, first_line, last_line, body) of the headings of a level; lines before the first are section 0."""
    title = F.regexp_extract("line", rf"^#{{{level}}}(?U)\s+(.+)", 1)
    own = F.when(title != "", 1).otherwise(0)
    rows = lines.select("file", "line_no", "line", title.alias("title"), F.sum(own).over(W.partitionBy("file").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)).alias("section_no"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    found = rows.groupBy("file", "section_no").agg(F.max(strip(F.col("title"))).alias("title"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), body.alias("body"))
    return found.where((F.col("section_no") > 0) | (strip(F.col("body")) != ""))


def chapters(lines: DataFrame, few: int = 6) -> DataFrame:
    """(file, part, sub, title, body, name): sections of level 2; where a book has fewer than ``few``, those of level 3 in them."""
    parts = sections(lines, 2).where("section_no > 0").withColumn("n", F.count("*").over(W.partitionBy("file")))
    inner = parts.select(F.concat_ws("/", "file", F.col("section_no").cast("string")).alias("file"), F.col("file").alias("book"), "section_no", F.col("title").alias("part_title"), "n", F.posexplode(F.split("body", "\n", -1)).alias("line_no", "line"))
    cut = sections(inner.select("file", "line_no", "line"), 3).select("file", F.col("section_no").alias("own"), F.col("title").alias("own_title"), F.col("body").alias("own_body"))
    known = inner.select("file", "book", "section_no", "part_title", "n").distinct()
    count = cut.withColumn("subs", F.max("own").over(W.partitionBy("file")))
    small = count.join(known, "file").where((F.col("n") < few) & (F.col("subs") > 0))
    small = small.select(F.col("book").alias("file"), F.col("section_no").alias("part"), F.when(F.col("own_title") != "", F.col("own_title")).otherwise(F.col("part_title")).alias("title"), F.col("own_body").alias("body"), "own")
    small = small.withColumn("sub", F.row_number().over(W.partitionBy("file", "part").orderBy("own"))).withColumn("subs", F.count("*").over(W.partitionBy("file", "part"))).drop("own")
    kept = small.select("file", "part").distinct()
    whole = parts.select("file", F.col("section_no").alias("part"), "title", "body", F.lit(1).alias("sub"), F.lit(1).cast("long").alias("subs")).join(kept, ["file", "part"], "left_anti")
    rows = whole.unionByName(small)
    slug = F.when(T.slug(F.col("title")) != "", T.slug(F.col("title"))).otherwise("preamble")
    name = F.when(F.col("subs") == 1, F.format_string("%02d_%s", F.col("part").cast("int"), slug)).otherwise(F.format_string("%02d_%02d_%s", F.col("part").cast("int"), F.col("sub").cast("int"), slug))
    return rows.select("file", F.col("part").cast("int").alias("part"), F.col("sub").cast("int").alias("sub"), "title", T.published(F.col("body")).alias("body"), name.alias("name"))


def pages_of(chapters_: DataFrame, title: str, book: str, stamp: str, note: str = "") -> DataFrame:
    """(name, text): chapters with front matter and a link back. stamp: the date to write."""
    head = F.concat(F.lit(f"---\ntitle: {title} / "), "title", F.lit(f"\np: {book}/"), "name", F.lit(f"\ndate: {stamp}\n---\n\n{note}\n\n\n[↩️ 轉總目錄](/{book})\n\n"))
    return chapters_.select("name", F.concat(head, "body").alias("text"))


def index_of(chapters_: DataFrame, book: str) -> DataFrame:
    """(file, text): a list of links to the chapters in order."""
    line = F.concat(F.when(F.col("sub") > 1, "  ").otherwise(""), F.lit("- ["), blank(F.col("title")), F.lit(f"](/{book}/"), "name", F.lit(")"))
    return chapters_.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "sub", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
