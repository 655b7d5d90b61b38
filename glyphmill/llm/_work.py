"""Where jobs keep what must outlive an executor, and what several operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers that may be broadcast, after they are counted.
FEW = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Where it is unset and all run in one process, as in tests, a
    temporary folder is set and used."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="glyphmill-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Spark hands Python up to 64 MB or 10,000 rows at once unless told otherwise. Where the session still has that size, it gets a
    smaller one, so that workers' memory doesn't follow the length of texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("bB") in ("67108864", "64m"):
        spark.conf.set(key, str(most))


def new_folder(spark: SparkSession, what: str) -> str:
    """A new folder's path below the shared one; it is deleted when the session's JVM ends."""
    at = f"{shared_folder(spark)}/glyphmill-{what}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return str(fs.makeQualified(path).toString())


#: Options for rows of megabytes: Parquet looks at the size of a page or row group after each few rows, not after hundreds.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4", "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "4", "parquet.block.size": str(16 << 20)}


def stored(df: DataFrame, what: str, **options: str) -> DataFrame:
    """The same rows, written once as Parquet to the shared folder and read from there: lineage ends, lost executors cost nothing."""
    at = new_folder(df.sparkSession, what)
    df.write.mode("overwrite").options(**options).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def drop_stored(*some: DataFrame) -> None:
    """Deletes what stored() wrote, once nothing reads it any more."""
    for df in some:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def only(rows: DataFrame, keys: DataFrame, on: str | list[str], how: str = "left_semi", most: int = FEW) -> DataFrame:
    """The rows with (or, left_anti, without) a key among keys: by broadcast if these are counted to be few, else by a shuffle."""
    few = keys.limit(most + 1).count() <= most
    return rows.join(F.broadcast(keys) if few else keys, on, how)


def meet(rows: DataFrame, keys: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """rows joined with keys, which have one row for each value of ``on``. Values with over a thousandth of all rows, 1000 at most, meet
    their row by broadcast, so none of them falls to one task; the others by a shuffle."""
    on = [on] if isinstance(on, str) else on
    total = rows.count()
    if total <= 10_000:
        return rows.join(keys, on, how)
    often = stored(rows.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > max(1000, total / 1000)).select(*on), "often")
    if not often.limit(1).count():
        return rows.join(keys, on, how)
    hot = F.broadcast(often)
    of_hot = F.broadcast(keys.join(hot, on, "left_semi"))
    return rows.join(hot, on, "left_anti").join(keys, on, how).unionByName(rows.join(hot, on, "left_semi").join(of_hot, on, how))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the graph with the edges (a, b), a and b long: the smallest node that can be reached.

    In each round every node points to its smallest neighbour, if that is smaller; pointers are followed to their ends, by pointers of
    pointers, so in as many steps as the logarithm of their length; then nodes are put together with their ends, and what edges are left
    between different ends make the next round's graph, which is much smaller. What a step gives is written to the shared folder. Nodes
    with many edges meet in minima with map-side combine and by meet(). It ends when no edge is left."""
    span = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    links = stored(edges.where("a <> b").select(*span).distinct(), "links")
    labels = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("end")), "ends")
        few = ends.count() <= FEW
        join = (lambda rows, keys, on: rows.join(F.broadcast(keys), on)) if few else meet
        while True:
            # Several steps at once where they are cheap; if the last of them moved nothing, pointers have ended.
            further = ends
            for _ in range(4 if few else 1):
                step = join(further.select("node", "end"), ends.select(F.col("node").alias("end"), F.col("end").alias("next")), "end")
                further = step.select("node", F.col("end").alias("was"), F.col("next").alias("end"))
            further = stored(further, "ends")
            moved = further.where("was <> end").limit(1).count()
            drop_stored(ends)
            ends = further.select("node", "end")
            if not moved:
                break
        shorter = join(links, ends.select(F.col("node").alias("a"), F.col("end").alias("x")), "a")
        shorter = join(shorter, ends.select(F.col("node").alias("b"), F.col("end").alias("y")), "b")
        rest = stored(shorter.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if labels is None:
            labels = ends.withColumnRenamed("end", "component")
        else:
            known = ends.select(F.col("node").alias("component"), "end")
            after = labels.join(F.broadcast(known), "component", "left") if few else meet(labels, known, "component", "left")
            after = stored(after.select("node", F.coalesce("end", "component").alias("component")), "labels")
            drop_stored(labels, ends)
            labels = after
        drop_stored(links)
        links = rest
        if not links.limit(1).count():
            return labels
