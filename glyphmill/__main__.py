"""python -m glyphmill TEXT [FROM] [TO]: one text from a romanization to another, or to all others."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from glyphmill.functions.syllables import translate
from glyphmill.functions.systems import SYSTEMS


def convert(spark: SparkSession, text: str, given: str, wanted: list[str]) -> dict[str, str]:
    row = spark.createDataFrame([(text,)], "t string").select(*[translate(F.col("t"), given, w).alias(w) for w in wanted]).first()
    return row.asDict()


def main(args: list[str]) -> int:
    if not 1 <= len(args) <= 3 or any(a.upper() not in SYSTEMS for a in args[1:]):
        print(f"{__doc__}\nSystems: {', '.join(SYSTEMS)}", file=sys.stderr)
        return 2
    given = args[1].upper() if len(args) > 1 else "LATN_NORM"
    wanted = [args[2].upper()] if len(args) > 2 else [s for s in SYSTEMS if s != given]
    spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name, text in convert(spark, args[0], given, wanted).items():
        print(f"{name}: {text}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
