"""Imported tables: importers by folder, their files in order; paths of exported tables.

Files are listed by Spark's file source, so paths of any of its file systems do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import extract as X
from glyphmill.sources import readers

Importer = Callable[[SparkSession, str, str], DataFrame]
#: Folder to (patterns of its files in order, function of session, path and source).
IMPORTERS: dict[str, tuple[tuple[str, ...], Importer]] = {}


def importer(folder: str, *patterns: str):
    """Registers a function for a folder of imported files."""

    def keep(function: Importer) -> Importer:
        IMPORTERS[folder] = (patterns, function)
        return function

    return keep


def name_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def stem_of(path: str) -> str:
    return name_of(path).rpartition(".")[0]


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def files(spark: SparkSession, path: str, pattern: str, deep: bool = True) -> list[str]:
    """The files of a folder (and of those in it) that fit a pattern, sorted; their contents aren't read."""
    if not exists(spark, path):
        return []
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", str(deep).lower()).option("pathGlobFilter", pattern).load(path)
    return sorted(r["path"] for r in rows.select("path").collect())


@importer("ChhoeTaigiDatabase", "*.csv", "*.tsv")
def word_file(spark: SparkSession, path: str, source: str) -> DataFrame:
    rows = readers.table(spark, path, sep="\t" if path.endswith(".tsv") else ",")
    return X.word_table(rows, F.lit(source))


@importer("dieghv", "*.dict.yaml")
def reading_file(spark: SparkSession, path: str, source: str) -> DataFrame:
    return X.readings(readers.dictionary(spark, path), F.lit(source))


def external_files(spark: SparkSession, root: str) -> list[tuple[str, str, Importer]]:
    """(folder, path, importer): folders in the order of their names, in each the files of one pattern after those of the one before."""
    found = []
    for folder, (patterns, function) in sorted(IMPORTERS.items()):
        for pattern in patterns:
            found += [(folder, p, function) for p in files(spark, f"{root}/{folder}", pattern) if pattern != "*.dict.yaml" or not any(s in name_of(p) for s in readers.SKIPPED)]
    return found


def external(spark: SparkSession, root: str) -> DataFrame | None:
    """All entries of all importers with file_no, the place of their file in that order; None if there are no files."""
    out = None
    for i, (folder, path, function) in enumerate(external_files(spark, root)):
        rows = function(spark, path, f"{folder} > {stem_of(path)}").withColumn("file_no", F.lit(i)).withColumn("file", F.lit(stem_of(path)))
        out = rows if out is None else out.unionByName(rows)
    return out


def exported_tables(spark: SparkSession, root: str, targets: list[str] | None = None) -> tuple[list[str], list[str]]:
    """(CSV files, warnings). Without targets the imported, clipped and book tables and the merged one, as far as they are there; a target
    is a file or a folder, below root or absolute."""
    if not targets:
        found = [p for part in ("external", "clippings", "books") for p in files(spark, f"{root}/{part}", "*.csv", deep=False)]
        return found + ([f"{root}/merged.csv"] if exists(spark, f"{root}/merged.csv") else []), []
    found, warnings = [], []
    for t in targets:
        path = t if t.startswith("/") or "://" in t else f"{root}/{t}"
        if not exists(spark, path):
            warnings.append(f"path not found: {path}")
        elif name_of(path).endswith(".csv"):
            found.append(path)
        else:
            found += files(spark, path, "*.csv", deep=False)
    return found, warnings
