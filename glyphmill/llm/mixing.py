"""Mixing sources to target weights, by weighted sampling without replacement (Efraimidis and Spirakis).

Each document gets the key -ln(u) / w: u from a hash of its id and the seed, w its quality weight; the smallest keys come first.
A source that is to give more words than it has gives whole epochs first; the rest of its budget is filled by its documents in key
order, up to the one at which the prefix sum comes nearest to the budget.

The prefix sum isn't taken over a whole source: keys fall into ranges, about ``in_range`` documents each, whose sums show in which
range the budget of a source ends. Only the documents of that range are sorted; those before it are taken, those after aren't. So a
source with a third of all rows is worked on in as many tasks as any. A source's row reaches its documents by broadcast if there are few
sources (they are counted), else by a salted join.

Defined cases: a null text has size 0. A null source is a source of its own, ordered last. A null doc_id draws as the empty string does.
Equal keys are ordered by id, then by a hash of the text; equal rows are taken together. With no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.llm._work import stored

MOST_EPOCHS = 3
SALTS = 64


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def symbol_weight(text: Column, size: Column) -> Column:
    """A quality weight in (0, 1]: 1 without symbols, 1/2 with one symbol a word."""
    return 1 / (1 + F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]")) / F.greatest(size, F.lit(1)))


def targets(sources: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """sources: (source, size, weight), one row each. Adds target: shares of all sizes by weight; what a source can't give in ``most``
    epochs is shared out again by weight. That ends at min(most * size, x * weight) with one x for all: sources that stop are those
    with the smallest most * size / weight, so running sums in that order give x."""
    order = W.orderBy(F.col("full") / F.col("weight"), "source")
    upto, whole = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(F.lit(0))
    x = sources.withColumn("full", most * F.col("size"))
    x = x.withColumn("before", F.coalesce(F.sum("full").over(upto), F.lit(0))).withColumn("left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    x = x.withColumn("level", (F.sum("size").over(whole) - F.col("before")) / F.col("left"))
    x = x.withColumn("stops", F.col("full") <= F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("stops"), F.struct(F.col("full") / F.col("weight"), F.col("level")))).over(whole)["level"]
    target = F.when(F.col("stops"), F.col("full").cast("double")).otherwise(level * F.col("weight"))
    return x.select("source", "size", target.alias("target"))


def mixed(docs: DataFrame, weight_of: Column | None = None, quality: Column | None = None, seed: str = "mix", in_range: int = 4096, broadcast_sources: int = 10_000, keep: list[str] | None = None) -> DataFrame:
    """(row: columns of docs or those in keep, size, source_size, target, times: how often the mix takes the document, taken: its words
    in the mix). weight_of: a source's weight, of the columns ``rank`` (1, 2, ... in code-point order) and ``source``."""
    size = n_words(F.col("text"))
    quality = symbol_weight(F.col("text"), size) if quality is None else quality
    digits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long")
    key = -F.log((digits + 0.5) / float(1 << 52)) / quality
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("source"), F.col("source").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), size.alias("size"), key.alias("key"))
    # The sums need no texts: unless few columns are kept, a document's row is made again when it is given out.
    rows = stored(whole if keep else whole.drop("row"), "mix")

    sums = rows.groupBy("source", "none").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    ranked = sums.withColumn("rank", F.row_number().over(W.orderBy("none", "source")))
    weighted = ranked.withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("long") if weight_of is None else weight_of)
    aims = targets(weighted.select("source", "size", "weight")).withColumnRenamed("size", "source_size")
    aims = aims.join(sums.select("source", "n"), "source").withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    aims = aims.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("ranges", F.ceil(F.col("n") / in_range))
    aims = stored(aims.drop("n"), "aims")

    few = aims.count() <= broadcast_sources

    def with_source(some: DataFrame, known: DataFrame) -> DataFrame:
        """some and its source's row in known: broadcast if sources are counted to be few, else repeated for each salt."""
        if few:
            return some.join(F.broadcast(known), "source")
        salt = F.pmod(F.xxhash64("id", "hash"), F.lit(SALTS))
        spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        return some.withColumn("salt", salt).join(spread, ["source", "salt"]).drop("salt")

    place = F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("ranges")), F.col("ranges") - 1)
    placed = with_source(rows, aims).withColumn("range", place)
    parts = placed.groupBy("source", "range", "rest").agg(F.sum("size").alias("size"))
    start = F.sum("size").over(W.partitionBy("source").orderBy("range")) - F.col("size")
    ends = parts.withColumn("start", start).where((F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("size")))
    ends = stored(ends.select("source", F.col("range").alias("end"), "start"), "ends")

    near = with_source(rows, aims.join(ends, "source")).withColumn("range", place).where(F.col("range") == F.col("end"))
    before = F.sum("size").over(W.partitionBy("source").orderBy("key", "id", "hash").rowsBetween(W.unboundedPreceding, -1))
    near = near.withColumn("before", F.col("start") + F.coalesce(before, F.lit(0)))
    last = near.where(2 * (F.col("rest") - F.col("before")) >= F.col("size")).groupBy("source").agg(F.max(F.struct("key", "id", "hash")).alias("last"))

    bound = aims.join(ends.select("source", "end"), "source", "left").join(last, "source", "left")
    out = with_source(rows if keep else whole, bound).withColumn("range", place)
    more = F.when(F.col("end").isNull(), F.lit(False)).when(F.col("range") < F.col("end"), True).when(F.col("range") > F.col("end"), False).otherwise(F.coalesce(F.struct("key", "id", "hash") <= F.col("last"), F.lit(False)))
    out = out.withColumn("times", F.col("epochs") + more.cast("long"))
    return out.select("row", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs."""
    return mixed(docs, **settings).where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("row.*")
