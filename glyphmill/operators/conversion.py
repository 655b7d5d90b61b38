"""Conversion of texts between systems by tables of syllables.

Texts are taken apart into syllables and what stands between them. Each distinct syllable is converted once, through joins with the
systems' rule tables, and the results are put back in order. Marked vowels are read by a reverse index, marked form to vowel and tone: each place of a syllable is probed with the longest
form first, as each length of a form is one equality. So work follows the number of different syllables, which a language has a few thousand of, not
that of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.columns import pieces, restored
from glyphmill.functions.syllables import LETTERS, SPOKEN, TYPED, keyboard_syllable, marked_syllable, nfc, translate
from glyphmill.functions.systems import CHECKED, System, named

#: What belongs to a syllable in any of the forms; all else, hyphens too, stands between syllables.
INSIDE = "".join(dict.fromkeys([LETTERS, SPOKEN, TYPED.replace(r"\-", ""), "0-9"]))


def vowel_index(s: System) -> list[tuple[str, str, int, bool, bool]]:
    """(form, vowel, tone, marked, in a checked syllable): what each marked form of a vowel stands for."""
    return [(form, v, t, m, checked) for checked in (False, True) for form, (v, t, m) in s.readings(checked).items()]


def read_vowels(syllables: DataFrame, system: str) -> DataFrame:
    """(syllable, base, tone) of distinct marked syllables in small letters: letters without marks, and the tone that the marks give; with several the last mark
    decides. Each place meets the index in all lengths that forms have; of what overlaps the leftmost counts, and the longest from a place."""
    s = named(system)
    spark = syllables.sparkSession
    index = F.broadcast(spark.createDataFrame(vowel_index(s), "form string, vowel string, t int, marked boolean, checked boolean"))
    stops = "|".join(s.stops.split())
    longest = max(len(f) for row in s.vowels.values() for f in row)
    rows = syllables.select("syllable", F.col("syllable").rlike(f"(?:{stops})$").alias("checked"))
    places = rows.select("syllable", "checked", F.explode(F.sequence(F.lit(1), F.length("syllable"))).alias("at"))
    tried = places.select("syllable", "checked", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("syllable") - F.col("at") + 1))).alias("n"))
    tried = tried.withColumn("form", F.substring("syllable", F.col("at"), F.col("n"))).withColumn("next", F.substring("syllable", F.col("at") + F.col("n"), F.lit(1)))
    # A form of several characters is whole only if no mark follows.
    whole = (F.col("n") == 1) | ~F.col("next").rlike(r"^\p{M}")
    found = tried.where(whole).join(index, ["form", "checked"]).groupBy("syllable", "at").agg(F.max(F.struct("n", "vowel", "t", "marked")).alias("x"))
    lists = rows.join(found.groupBy("syllable").agg(F.array_sort(F.collect_list(F.struct("at", "x.*"))).alias("all")), "syllable", "left")
    kind = "struct<stop:int,base:string,first:int,strong:int>"
    start = F.struct(F.lit(1).alias("stop"), F.lit("").alias("base"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("strong")).cast(kind)

    def step(a: Column, x: Column) -> Column:
        between = F.substring("syllable", a["stop"], x["at"] - a["stop"])
        strong = F.when(x["marked"] & (x["t"] > 1), x["t"]).otherwise(a["strong"])
        own = F.struct((x["at"] + x["n"]).alias("stop"), F.concat(a["base"], between, x["vowel"]).alias("base"), F.coalesce(a["first"], x["t"]).alias("first"), strong.alias("strong")).cast(kind)
        return F.when(x["at"] >= a["stop"], own).otherwise(a)

    none = F.array().cast("array<struct<at:int,n:int,vowel:string,t:int,marked:boolean>>")
    read = F.aggregate(F.coalesce("all", none), start, step)
    rows = lists.select("syllable", read.alias("r")).select("syllable", F.concat("r.base", F.expr("substring(syllable, r.stop)")).alias("base"), F.coalesce("r.strong", "r.first", F.lit(1)).alias("tone"))
    single = "".join(e for e in s.stops.split() if len(e) == 1)
    tone = F.when(~F.col("tone").isin(*CHECKED) & F.col("base").rlike(f"[{single}]$"), F.when(F.col("tone") > 1, 8).otherwise(4)).otherwise(F.col("tone"))
    base = F.regexp_replace("base", r"(?U)\d", "")
    for sign, letters in reversed(s.spelling.items()):
        base = F.when(F.contains(F.regexp_replace("base", r"(?U)\d", ""), F.lit(sign)), F.replace(F.regexp_replace("base", r"(?U)\d", ""), F.lit(sign), F.lit(letters))).otherwise(base)
    return rows.select("syllable", base.alias("base"), tone.alias("tone"))


def syllables_in(texts: DataFrame, column: str) -> DataFrame:
    """(text, at, piece, syllable): distinct texts as pieces in order; syllable is a piece in small letters, null for what stands between."""
    known = texts.select(F.col(column).alias("text")).where("text is not null").distinct()
    each = known.select("text", F.posexplode(pieces(nfc(F.col("text")), rf"(?s)[{INSIDE}]+|[^{INSIDE}]+")).alias("at", "piece"))
    return each.withColumn("syllable", F.when(F.col("piece").rlike(f"^[{INSIDE}]"), F.lower("piece")))


def put_back(df: DataFrame, column: str, parts: DataFrame, into: str) -> DataFrame:
    """df with its texts put together again from (text, at, new)."""
    whole = parts.groupBy("text").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("x")).select("text", F.array_join(F.transform("x", lambda p: p["new"]), "").alias(into))
    return df.join(whole.withColumnRenamed("text", "__text"), df[column] == F.col("__text"), "left").withColumn(into, F.when(F.col(column) == "", "").otherwise(F.col(into))).drop("__text")


def _by_syllable(df: DataFrame, column: str, into: str, table, case=lambda new, old: new) -> DataFrame:
    """table: (syllable) to (syllable, converted); case: what is put for a piece whose syllable became new."""
    parts = syllables_in(df, column)
    found = table(parts.select("syllable").where("syllable is not null").distinct())
    met = parts.join(found, "syllable", "left").select("text", "at", F.when(F.col("syllable").isNull(), F.col("piece")).otherwise(case(F.col("converted"), F.col("piece"))).alias("new"))
    return put_back(df, column, met, into)


def typed(df: DataFrame, column: str, system: str, into: str) -> DataFrame:
    """df with a column's marked syllables as typed, read by the vowel index; syllables with a digit are only respelled."""

    def table(syllables: DataFrame) -> DataFrame:
        marked = syllables.where(~F.col("syllable").rlike(r"(?U)[\d⁰¹²³⁴⁵⁶⁷⁸⁹]"))
        read = read_vowels(marked, system).select("syllable", F.concat("base", F.col("tone").cast("string")).alias("converted"))
        others = syllables.join(read.select("syllable"), "syllable", "left_anti")
        return read.unionByName(others.select("syllable", keyboard_syllable(F.col("syllable"), system).alias("converted")))

    return _by_syllable(df, column, into, table, restored)


def written(df: DataFrame, column: str, system: str, into: str) -> DataFrame:
    """df with a column's typed syllables in marked form."""
    return _by_syllable(df, column, into, lambda syllables: syllables.select("syllable", nfc(marked_syllable(F.col("syllable"), system)).alias("converted")), lambda new, old: restored(new, old, upper_with_digits=False))


def converted(df: DataFrame, column: str, source: str, target: str, into: str) -> DataFrame:
    """df with a column's marked syllables in another system's marked form, in small letters as translate() gives them."""
    return _by_syllable(df, column, into, lambda syllables: syllables.select("syllable", translate(F.col("syllable"), source, target).alias("converted")))
