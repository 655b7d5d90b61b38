"""Reverse lookup: from English and Mandarin to the lexicon, spelling algebra, ranked and ordered candidates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.functions.columns import blank, strip, subs
from glyphmill.functions.syllables import handwriting, keyboard, translate
from glyphmill.functions.systems import named
from glyphmill.operators.lexicon import present
from glyphmill.operators.spelling import respelled

USABLE = "^[-:#]"


def usable(text: Column) -> Column:
    return (text != "") & ~text.rlike(USABLE)


def shown(rows: DataFrame, system: str) -> Column:
    """A row's romanization in the system's usual form."""
    own = strip(blank(F.col(system.lower()))) if system.lower() in [c.lower() for c in rows.columns] else F.lit("")
    given = strip(subs(F.when(own != "", own).otherwise(translate(F.col("_latn"), "LATN_NORM", system)), (r"[:\[\]#]+", "")))
    usual = T.untagged(handwriting(keyboard(given, system), system))
    return F.replace(usual, F.lit("-"), F.lit("")) if system.upper() == "DP" else usual


def _first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the first."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")


def english(rows: DataFrame, system: str, systems: list[str] | None = None) -> DataFrame:
    """(text, code, weight, seq): English keys with the Han text and romanization they stand for. Sort by lower(code), seq."""
    rows = rows.where(present(systems)) if systems else rows
    rows = rows.where((F.col("_latn") != "") & ~F.col("_latn").rlike('[".]') & ~blank(F.col("han")).rlike("[。.!?！？]"))
    found = rows.select("seq", T.english_key(strip(blank(F.col("en")))).alias("code"), T.unbracketed(strip(blank(F.col("han")))).alias("han"), shown(rows, system).alias("hw")).where("code <> ''")
    h, r = usable(F.col("han")), usable(F.col("hw"))
    text = F.when(h & r, F.concat("han", F.lit(" ("), "hw", F.lit(")"))).when(h, F.col("han")).when(r, F.col("hw"))
    kind = F.when(h & r, 0).when(h, 1).otherwise(2)
    found = found.select("seq", "code", text.alias("text"), kind.alias("kind"), F.when(kind == 2, 50).otherwise(100).alias("weight")).where("text is not null")
    return _first(found, ["kind", "text", "code"], "seq").select("text", "code", "weight", "seq")


def mandarin(rows: DataFrame, system: str, readings: dict[str, str], systems: list[str] | None = None) -> DataFrame:
    """(text, code, weight, seq, part): toneless readings of each part of a gloss. readings: syllable by character. Sort by code, seq, part."""
    rows = rows.where(present(systems)) if systems else rows
    gloss = strip(blank(F.col("zh_TW")))
    rows = rows.where((gloss != "") & (F.col("_latn") != "") & ~F.col("_latn").rlike('[".]'))
    rows = rows.select("seq", gloss.alias("gloss"), T.unbracketed(strip(blank(F.col("han")))).alias("han"), shown(rows, system).alias("hw"), T.gloss_parts(gloss).alias("parts"), T.pinyin_keys(gloss, readings).alias("keys"))
    rows = rows.select("seq", "gloss", "han", "hw", "parts", F.posexplode("keys").alias("part", "code"))
    label = F.coalesce(F.get("parts", F.col("part")), F.col("gloss"))
    said = F.when(usable(F.col("han")), F.when(F.col("hw") != "", F.concat("han", F.lit(" ("), "hw", F.lit(")"))).otherwise(F.col("han"))).when(usable(F.col("hw")), F.col("hw"))
    found = rows.select("seq", "part", "code", F.concat(label, F.lit("☞"), said).alias("text"), F.struct("seq", "part").alias("at")).where("text is not null")
    return _first(found, ["text", "code"], "at").select("text", "code", F.lit(100).alias("weight"), "seq", "part")


def initial_rules(rules: dict[str, str]) -> list[str]:
    """xform rules for a map of initials. Rules work on what earlier ones left, and a new initial may be another's old one (p to b, ph to p),
    so each fits only where no longer initial goes on, and shorter ones come first. The text of the rules is a fixed value: input
    engines read it."""
    following = {key: sorted({other[len(key)] for other in rules if len(other) > len(key) and other.startswith(key)}) for key in rules}
    ahead = {key: f"(?=[^{''.join(letters)}])" if letters else "" for key, letters in following.items()}
    return [f"xform/^{key}{ahead[key]}/{rules[key]}/" for _, key in sorted((len(key), key) for key in rules)]


def algebra(system: str) -> list[str]:
    """The spelling rules of a system: optional hyphens and tones, its initials, vowels and endings, any case."""
    s = named(system)
    initials = {k: v for k, v in s.from_pivot.get("initial", {}).items() if k not in s.before_front and not callable(v)}
    endings = [f"xform/{k}$/{v}/" for k, v in sorted(s.from_pivot.get("ending", {}).items(), key=lambda x: -len(x[0])) if not callable(v)]
    return ["derive/ /-/", "derive/[1-8]//", *initial_rules(initials), *s.algebra, *endings, *[f"derive/{c}/{c.upper()}/" for c in "abcdefghijklmnopqrstuvwxyz"]]


def spelled(dictionary: DataFrame, rules: list[str]) -> DataFrame:
    """(spelling, text, code, weight) of all ways to type each entry, its whole code taken at once: made once and written, it answers every keystroke.
    For whole rule lists, which double the ways with each letter, there is spelling.prefix_index()."""
    ways = respelled(dictionary.select("code").distinct(), rules)
    return dictionary.join(ways, "code").select("spelling", "text", "code", "weight")


def typed_in(table: DataFrame, typed: str, most: int = 6) -> DataFrame:
    """A page of candidates from a table of spelled(): entries one of whose spellings begins with what was typed, the heaviest first."""
    rows = table.where(F.col("spelling").startswith(typed)).select("text", "code", "weight").distinct()
    return rows.orderBy(F.desc("weight"), "text", "code").limit(most)


def ranked(dictionary: DataFrame, typed: str, rules: list[str], most: int = 6) -> DataFrame:
    """A page of candidates for what was typed. For many keystrokes write spelled() and ask typed_in()."""
    return typed_in(spelled(dictionary, rules), typed, most)


def capital(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


def candidates(rows: DataFrame, table: DataFrame, typed: str) -> DataFrame:
    """Candidates (text, code, span, seq) in the order they are shown, with ``comment``: a Han text's code in marked form. Where digits or capitals
    were typed, whole Latin texts come first, then whole Han texts by span, then parts of both; else the order stays."""
    words = rows.select("*", F.posexplode(F.split("code", "(?<= )(?! )|(?<! )(?= )", -1)).alias("place", "piece"))
    looked = words.join(table.select(F.col("code").alias("piece"), F.col("text").alias("marked")), "piece", "left")
    built = looked.groupBy("seq", "text", "code", "span").agg(F.array_sort(F.collect_list(F.struct("place", F.coalesce("marked", "piece").alias("v")))).alias("v"))
    comment = F.replace(F.replace(F.array_join(F.transform("v", lambda x: x["v"]), ""), F.lit("   "), F.lit("--")), F.lit("  "), F.lit("-"))
    han = F.col("text").rlike(r"[\x{3000}-\x{9fff}\x{10000}-\x{3ffff}]")
    whole = F.col("span") >= len(typed)
    marked = bool(re.search("[0-9A-Z]", typed))
    kind = F.when(~han & whole, 0).when(han & whole, 1).when(~han, 2).otherwise(3) if marked else F.lit(0)
    shown_text = F.when(~han & F.lit(typed[:1].isupper()), capital(F.col("text"))).otherwise(F.col("text"))
    out = built.select("seq", shown_text.alias("text"), F.when(han, comment).otherwise("").alias("comment"), kind.alias("kind"), F.when((kind == 1) | (kind == 3), -F.col("span")).otherwise(0).alias("order"))
    return out.select("text", "comment", F.row_number().over(W.orderBy("kind", "order", "seq")).alias("place"))
