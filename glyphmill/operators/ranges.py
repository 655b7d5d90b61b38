"""Results that depend on an order of all rows, without all rows in one task.

Rows are dealt by ranges of the order and sorted in their range. What one range needs from those before it, a count or a last value, is a row for each
range; those few rows meet in a window, and what they give goes back to the ranges. A file of any length is as many ranges as its lines
need, and the number of rows that meet at once is that of the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.sources.shared import kept

LOW = (1 << 33) - 1


def dealt(rows: DataFrame, *order: str | Column) -> DataFrame:
    """The rows, written, with __part, the number of their range by ``order``, and __local, their place in it. Rows that the order
    doesn't tell apart stay in the order in which they are read, and a great many of those are several ranges too."""
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = rows.withColumn("__read", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(*by, "__read").sortWithinPartitions(*by, "__read").drop("__read").withColumn("__at", F.monotonically_increasing_id())
    out = kept(placed, "ranges")
    return out.withColumns({"__part": F.shiftright("__at", 33), "__local": F.col("__at").bitwiseAND(LOW)}).drop("__at")


def _before(counts: DataFrame, by: list[str]) -> DataFrame:
    """Sums of ``n`` over the ranges before, for each key or over all."""
    window = (W.partitionBy(*by) if by else W.partitionBy()).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("__before", F.coalesce(F.sum("n").over(window), F.lit(0)))


def numbered(rows: DataFrame, *order: str | Column, into: str = "row") -> DataFrame:
    """The rows with their number by an order, from 1 on: row_number() over all rows. Nulls come first where the order is ascending, as Spark has it."""
    placed = dealt(rows, *order)
    offsets = _before(placed.groupBy("__part").agg(F.count("*").alias("n")), []).select("__part", "__before")
    # A row for each range: as many as there are tasks.
    return placed.join(F.broadcast(offsets), "__part").withColumn(into, F.col("__before") + F.col("__local") + 1).drop("__part", "__local", "__before")


def filled_down(rows: DataFrame, by: str, order: str, **columns: Column) -> DataFrame:
    """The rows with, for each name, the last value that isn't null up to each row, in the order of the rows with the same ``by``: a forward fill.
    A window sees one range of one key; what was last before it comes from a window over ranges."""
    placed = dealt(rows.withColumns({f"__{c}": v for c, v in columns.items()}), by, order)
    last = placed.groupBy("__part", by).agg(*[F.max_by(f"__{c}", F.when(F.col(f"__{c}").isNotNull(), F.col("__local"))).alias(f"__{c}_last") for c in columns])
    over = W.partitionBy(by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("__part", F.col(by).alias("__by"), *[F.last(f"__{c}_last", ignorenulls=True).over(over).alias(f"__{c}_carried") for c in columns])
    inside = W.partitionBy("__part", by).orderBy("__local").rowsBetween(W.unboundedPreceding, 0)
    own = placed.withColumns({f"__{c}": F.last(f"__{c}", ignorenulls=True).over(inside) for c in columns})
    met = own.join(carried.withColumnRenamed("__part", "__carried_part"), (F.col("__part") == F.col("__carried_part")) & F.col(by).eqNullSafe(F.col("__by")), "left")
    met = met.withColumns({c: F.coalesce(f"__{c}", f"__{c}_carried") for c in columns})
    return met.select(*[c for c in rows.columns if c not in columns], *columns)
