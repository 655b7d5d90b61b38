"""Quality rules: documents are measured, failures are summed by host, and host verdicts are joined back.

All of it is DataFrame operations. One pass over the texts measures each document (one generator call, so no expression is evaluated
twice) and writes the figures to the shared folder. Failure rates by host are shrunk towards a beta prior fitted to all hosts by
the method of moments: rate = (failures + a) / (documents + a + b). A host whose shrunk rate is above ``host_limit`` is rejected
with all its documents. Only rejected hosts are joined back: broadcast if their number is small (it is counted first), else the
hosts are repeated for each of a number of salts, so that a host with a third of all documents doesn't fall to one task.

Defined cases: a null text has no words, so it fails. A null source is a host of its own. Repeated rows count each time and get equal
verdicts. Columns of the input are kept in a struct, so they may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._work import stored

SPACE = r"[\x20\x09-\x0D]+"
FIGURES = "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"


@dataclass(frozen=True)
class Rules:
    """A document fails the base rules with fewer than min_words words or over max_repeat percent of words in repeated windows. It fails
    the others with over max_symbols symbols for 100 words or over max_dup_lines percent of lines that repeat an earlier one."""

    min_words: int = 50
    max_repeat: int = 50
    max_symbols: int = 50
    max_dup_lines: int = 50
    window: int = 3
    host_limit: float = 0.5
    broadcast_hosts: int = 10_000
    salts: int = 64


def _repeat_words(words: Column, k: int) -> Column:
    """Words in windows of k that are found twice or more: windows sorted by hash stand beside their equals."""
    starts = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    hashed = F.sort_array(F.transform(starts, lambda i: F.struct(F.xxhash64(*[F.get(words, i + j) for j in range(k)]).alias("h"), i.alias("p"))))

    def places(s: Column) -> Column:
        same = lambda x, i: F.coalesce(x["h"] == F.get(s, i)["h"], F.lit(False))
        return F.sort_array(F.filter(F.transform(s, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["p"])), lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(k), F.coalesce(F.get(p, i + 1) - x, F.lit(k)))), F.lit(0).cast("long"), lambda a, x: a + x)

    held = F.transform(F.array(hashed), places)
    return F.get(F.transform(held, covered), F.lit(0))


def figures(text: Column, rules: Rules) -> Column:
    """An array of one struct with the figures of a text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    both = F.array(F.struct(F.filter(F.split(text, SPACE, -1), lambda w: w != "").alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("s")))
    return F.transform(
        both,
        lambda x: F.struct(
            F.size(x["w"]).cast("long").alias("n_words"),
            F.length(F.array_join(x["w"], "")).cast("long").alias("word_chars"),
            x["s"].cast("long").alias("n_symbols"),
            F.size(x["l"]).cast("long").alias("n_lines"),
            (F.size(x["l"]) - F.size(F.array_distinct(x["l"]))).cast("long").alias("n_dup_lines"),
            _repeat_words(x["w"], rules.window).alias("n_repeat_words"),
        ),
    )


def judged(docs: DataFrame, rules: Rules = Rules(), keep: list[str] | None = None) -> DataFrame:
    """(row: the columns of docs or those in keep, the figures, base_failed, failed, host_rejected, kept)."""
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row")
    host = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")).alias("host")
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat * F.col("n_words"))
    more = (100 * F.col("n_symbols") > rules.max_symbols * F.col("n_words")) | (100 * F.col("n_dup_lines") > rules.max_dup_lines * F.col("n_lines"))
    measured = docs.select(row, host, F.inline(figures(F.col("text"), rules))).withColumn("base_failed", base).withColumn("failed", base | more)
    measured = stored(measured, "figures")
    hosts = measured.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("f"))
    rate = F.col("f") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    mean, var = prior["m"] or 0.0, prior["v"] or 0.0
    weight = min(max(mean * (1 - mean) / var - 1, 1.0), 1000.0) if var > 0 else 1000.0
    bad = hosts.where((F.col("f") + mean * weight) / (F.col("n") + weight) > rules.host_limit).select("host", F.lit(True).alias("host_rejected"))
    n_bad = bad.count()
    if not n_bad:
        out = measured.withColumn("host_rejected", F.lit(False))
    elif n_bad <= rules.broadcast_hosts:
        out = measured.join(F.broadcast(bad), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("row"), F.lit(rules.salts)).alias("salt")
        out = measured.select("*", salt).join(bad.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rules.salts - 1).cast("long"))).alias("salt")), ["host", "salt"], "left")
    out = out.withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    return out.select("row", *FIGURES, "base_failed", "failed", "host_rejected", (~F.col("failed") & ~F.col("host_rejected")).alias("kept"))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of docs that pass, with the columns of docs."""
    return judged(docs, rules).where("kept").select("row.*")
