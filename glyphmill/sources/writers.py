"""Sinks: sorted CSV and text files, dictionaries with their headers, schema files, the lookup module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import validate
from glyphmill.operators.ranges import numbered
from glyphmill.sources.engine import STAMP, schema_text  # noqa: F401
from glyphmill.sources.external import exported_tables
from glyphmill.sources.readers import table



def csv(df: DataFrame, path: str, order: list, columns: list[str]) -> None:
    """A CSV folder whose part files in name order are sorted by order."""
    df.orderBy(*order).select(*columns).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="")


def book_csv(entries: DataFrame, path: str, columns: list[str]) -> None:
    """Entries sorted by romanization, earlier values blank where nothing changed."""
    from glyphmill.functions.text import unless_equal

    same = {c: unless_equal(F.col(c), F.col(c.removesuffix("_orig"))).alias(c) for c in columns if c.endswith("_orig")}
    key = F.lower(F.when(F.col("puj") != "", F.col("puj")).otherwise(F.col("poj")))
    csv(entries.withColumn("__key", key).select("*").withColumns({c: unless_equal(F.col(c), F.col(c.removesuffix("_orig"))) for c in same}), path, ["__key", "line_no", "part_no"], columns)


def texts(df: DataFrame, path: str) -> None:
    """(name, text): a folder for each name with the text in it."""
    df.select("name", F.col("text").alias("value")).write.mode("overwrite").partitionBy("name").text(path)


def header(name: str, note: str, stamp: str = STAMP, imports: tuple[str, ...] = (), options: tuple[str, ...] = ()) -> list[str]:
    lines = [f"# Rime dictionary: {name}", f"# {note}", "---", f"name: {name}", f'version: "{stamp}"', "sort: by_weight", *options]
    lines += ["import_tables:", *[f"  - {i}" for i in imports]] if imports else []
    return [*lines, "...", ""]


def dictionary(df: DataFrame, path: str, name: str, note: str, order: tuple[str, ...] = ("text", "code"), **head) -> None:
    """A dictionary: its header and lines of text, code and weight in order. The header is a row before all others, so the files stay parts of
    one sorted sequence."""
    spark = df.sparkSession
    top = spark.createDataFrame([(0, i, x) for i, x in enumerate(header(name, note, **head))], "part int, n int, value string")
    body = df.select(F.lit(1).alias("part"), F.lit(0).alias("n"), F.concat_ws("\t", "text", "code", F.col("weight").cast("string")).alias("value"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    every = top.unionByName(body, allowMissingColumns=True)
    every.orderBy("part", "n", *[f"k{i}" for i in range(len(order))]).select("value").write.mode("overwrite").text(path)


def renditions(books: DataFrame, path: str) -> None:
    """(file, text) of marked books: two texts each, the original and the modified, under names that end so."""
    from glyphmill.functions.text import modified, original

    two = F.array(F.struct(F.lit("_original").alias("kind"), original(F.col("text")).alias("text")), F.struct(F.lit("_modified").alias("kind"), modified(F.col("text"), "〔〕").alias("text")))
    texts(books.select("file", F.inline(two)).select(F.concat("file", "kind").alias("name"), "text"), path)


def syllabary_csv(rows: DataFrame, path: str) -> None:
    csv(rows, path, ["latn_norm", "han"], ["latn_norm", "puj", "han"])


def lua_lines(syllables: DataFrame) -> DataFrame:
    """(n, line): the syllable map (code, text) as a Lua table, its lines numbered from 0."""
    rows = numbered(syllables.select("code", "text"), "code", "text", into="n")
    ends = syllables.agg(F.count("*").alias("n")).select(F.inline(F.array(F.struct(F.lit(0).cast("long").alias("n"), F.lit("local SYLLABLE_MAP = {").alias("line")), F.struct((F.col("n") + 1).alias("n"), F.lit("}").alias("line")))))
    return rows.select("n", F.concat(F.lit('    ["'), "code", F.lit('"] = "'), "text", F.lit('",')).alias("line")).unionByName(ends)


def lua_table(syllables: DataFrame) -> str:
    """The syllable map as a Lua table. Its size is that of a syllabary, some thousands of rows whatever the lexicon's size."""
    return "\n".join(r["line"] for r in lua_lines(syllables).orderBy("n").collect())


def report(totals: DataFrame, kinds: DataFrame) -> tuple[str, int]:
    """A check's report, a line a file and kind, and 1 if there are errors, else 0."""
    rows = totals.orderBy(F.col("file").asc_nulls_last()).collect()
    lines = [f"{r['file'] or 'all'}: {r['rows']} rows, {r['errors']} errors, {r['warnings']} warnings" for r in rows]
    lines += [f"{k['kind']}: {k['n']}" for k in kinds.collect()]
    return "\n".join(lines), int(any(r["errors"] for r in rows))


def check(spark: SparkSession, root: str, targets: list[str] | None = None, errors_only: bool = False, output: str | None = None) -> tuple[str, int]:
    """Checks exported tables, those in targets or all below root. Returns the report and the exit code; with output, also writes the
    report there as text."""
    paths, warnings = exported_tables(spark, root, targets)
    lines, code = [f"WARNING: {w}" for w in warnings], 0
    if paths:
        rows = table(spark, paths, ["han", "en", *validate.SYSTEMS], rows=True)
        found = validate.findings(rows, errors_only).persist()
        text, code = report(validate.totals(rows, found), validate.top_kinds(found))
        found.unpersist()
        lines.append(text)
    if output:
        spark.createDataFrame([("\n".join(lines),)], "value string").write.mode("overwrite").text(output)
    return "\n".join(lines), code
