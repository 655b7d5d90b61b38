"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset and all runs in one process, as in tests, a temporary one is set and used."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="glyphmill-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def kept(df: DataFrame, what: str) -> DataFrame:
    """The same rows, written once as Parquet and read from there: lineage ends, and lost executors cost nothing. The folder goes
    when the session's JVM ends."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    at = str(fs.makeQualified(path).toString())
    df.write.mode("overwrite").parquet(at)
    return spark.read.schema(df.schema).parquet(at)
