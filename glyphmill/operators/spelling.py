"""Spelling rules over tables, and the index that answers what is typed.

A rule list works on a table of distinct codes or syllables, one projection for each rule, so it is applied once to each syllable of a language
and not to each phrase. Rules that allow capitals aren't spelled out: a letter's places in a syllable change case together, which is asked of
what was typed instead. The index has the heaviest entries for every prefix of so many letters; spellings of a phrase are those of
its syllables, joined one after another for as long as the prefix needs them.
"""

from __future__ import annotations

import re
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BETWEEN = "[ -]+"


class Rule(NamedTuple):
    verb: str
    old: str
    new: str


def parsed(rules: list[str]) -> list[Rule]:
    """Rules ``verb/old/new/``, whatever mark stands for the slash. A dollar sign without a number is itself."""
    found = []
    for rule in rules:
        verb = re.match("[a-z]+", rule)[0]
        old, new = rule[len(verb) + 1 :].split(rule[len(verb)])[:2]
        found.append(Rule(verb, old, new if verb == "xlit" else re.sub(r"\$(?!\d)", r"\\$", new)))
    return found


def without_case(rules: list[str]) -> tuple[list[str], bool]:
    """The rules before a closing list that allows a capital for each letter, and whether there is one."""
    case = [f"derive/{c}/{c.upper()}/" for c in "abcdefghijklmnopqrstuvwxyz"]
    return (rules[: -len(case)], True) if rules[-len(case) :] == case else (rules, False)


def _changed(text: Column, rule: Rule) -> Column:
    return F.translate(text, rule.old, rule.new) if rule.verb == "xlit" else F.regexp_replace(text, rule.old, rule.new)


def respelled(codes: DataFrame, rules: list[str]) -> DataFrame:
    """(code, spelling, rank) of distinct codes: xform and xlit replace a spelling, derive adds one, abbrev adds one with a lower rank.
    Of equal spellings the best rank counts. Null and empty codes have none."""
    rows = codes.select("code", F.col("code").alias("spelling"), F.lit(0).alias("rank")).where("code <> ''")
    for rule in parsed(rules):
        new = _changed(F.col("spelling"), rule)
        if rule.verb in ("xform", "xlit"):
            rows = rows.withColumn("spelling", new)
            continue
        more = F.struct(new.alias("spelling"), (F.col("rank") + int(rule.verb == "abbrev")).alias("rank"))
        both = F.array(F.struct("spelling", "rank"), F.when(F.col("spelling") != new, more))
        rows = rows.select("code", F.inline(F.filter(both, lambda x: x.isNotNull())))
    return rows.where("spelling <> ''").groupBy("code", "spelling").agg(F.min("rank").alias("rank"))


def syllables(code: Column) -> Column:
    """The syllables of a code, which spaces or hyphens part."""
    return F.filter(F.split(code, BETWEEN, -1), lambda s: s != "")


def _heads(leads: DataFrame, spelled: DataFrame, letters: int) -> DataFrame:
    """(lead, parts, rank, n): the first letters of all ways to spell a list of syllables, a space between syllables. The ways of all its
    syllables meet a list in one join; they are put together in its row, where a list has as many syllables as letters at most."""
    short = spelled.groupBy("code", F.substring("spelling", 1, letters).alias("s")).agg(F.min("rank").alias("r"))
    ways = short.groupBy(F.col("code").alias("syllable")).agg(F.collect_list(F.struct("s", "r")).alias("ways"))
    each = leads.select("lead", F.posexplode("lead").alias("i", "syllable")).join(ways, "syllable", "left")
    none = F.array().cast("array<struct<s:string,r:int>>")
    lists = each.groupBy("lead").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("ways", none).alias("ways")))).alias("ways"))

    def longer(h: Column, w: Column) -> Column:
        cut = F.substring(w["s"], F.lit(1), letters - h["n"])
        parts = F.when(h["parts"] == "", cut).otherwise(F.concat(h["parts"], F.lit(" "), cut))
        return F.struct(parts.alias("parts"), (h["rank"] + w["r"]).alias("rank"), (h["n"] + F.length(cut)).alias("n"))

    start = F.array(F.struct(F.lit("").alias("parts"), F.lit(0).alias("rank"), F.lit(0).alias("n")))
    step = lambda all_, x: F.array_distinct(F.flatten(F.transform(all_, lambda h: F.when(h["n"] >= letters, F.array(h)).otherwise(F.transform(x["ways"], lambda w: longer(h, w))))))
    return lists.select("lead", F.inline(F.aggregate("ways", start, step)))


def prefix_index(dictionary: DataFrame, rules: list[str], letters: int = 5, most: int = 6) -> DataFrame:
    """(prefix, parts, place, text, code, weight, rank): for every prefix, to so many letters, of a way to spell an entry (text, code, weight)
    the best entries by rank, weight, text and code; parts is the prefix with spaces where syllables end. Rules that allow capitals are left to typed_prefix().

    Places are row numbers with a limit, which Spark takes within each task before rows are dealt, so a prefix that a tenth of all
    entries share sends a few rows a task."""
    rules, _ = without_case(rules)
    # A spelling has a letter at least, so as many syllables as letters are enough.
    rows = dictionary.select("text", "code", "weight", F.slice(syllables(F.col("code")), 1, letters).alias("lead")).where(F.size("lead") > 0)
    known = rows.select(F.explode("lead").alias("code")).distinct()
    heads = _heads(rows.select("lead").distinct(), respelled(known, rules), letters)
    cuts = F.array(*[F.when(F.col("n") >= k, F.regexp_extract("parts", f"^(?: ?[^ ]){{{k}}}", 0)) for k in range(1, letters + 1)])
    heads = heads.select("lead", F.explode(F.array_compact(cuts)).alias("parts"), "rank").groupBy("lead", "parts").agg(F.min("rank").alias("rank"))
    met = rows.join(heads, "lead").select("parts", "text", "code", "weight", "rank")
    order = W.partitionBy("parts").orderBy("rank", F.desc("weight"), "text", "code")
    met = met.groupBy("parts", "text", "code").agg(F.min("rank").alias("rank"), F.max("weight").alias("weight"))
    best = met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    return best.select(F.replace("parts", F.lit(" "), F.lit("")).alias("prefix"), "parts", "place", "text", "code", "weight", "rank")


def best_of_prefix(index: DataFrame, most: int = 6) -> DataFrame:
    """(prefix, place, text, code, weight) of an index, wherever syllables end."""
    one = index.groupBy("prefix", "text", "code").agg(F.min("rank").alias("rank"), F.max("weight").alias("weight"))
    place = F.row_number().over(W.partitionBy("prefix").orderBy("rank", F.desc("weight"), "text", "code"))
    return one.withColumn("place", place).where(F.col("place") <= most).select("prefix", "place", "text", "code", "weight")


def fitting_parts(typed: str, any_case: bool = True) -> list[str]:
    """The ways in which what was typed may fall into syllables, in small letters: parted where it has a space or hyphen, and such that in each syllable
    a letter is always a capital or never."""
    pieces = [p for p in re.split(BETWEEN, typed) if p]
    letters = "".join(pieces)
    fixed = {sum(map(len, pieces[: i + 1])) for i in range(len(pieces) - 1)}
    free = [i for i in range(1, len(letters)) if i not in fixed]
    found = []
    for n in range(len(free) + 1):
        for some in combinations(free, n):
            at = [0, *sorted(fixed | set(some)), len(letters)]
            parts = [letters[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            if any_case and all(len({x for x in p if x.lower() == c}) == 1 for p in parts for c in set(p.lower())) or not any_case and letters == letters.lower():
                found.append(" ".join(parts).lower())
    return found if letters else []


def typed_prefix(index: DataFrame, typed: str, most: int = 6) -> DataFrame:
    """A page of candidates (place, text, code, weight) for what was typed, as many letters at most as the index has."""
    hits = index.where(F.col("parts").isin(*fitting_parts(typed)))
    return best_of_prefix(hits.withColumn("prefix", F.lit("")), most).drop("prefix").orderBy("place")
