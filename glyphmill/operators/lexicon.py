"""The merged lexicon and the weighted dictionaries made from it.

Results that depend on which row comes first take that from ``seq``, a column with the place of a row: (class, file, line, part) or a number.
Partitioning never decides. Weights are sums and minima, so they aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.functions.columns import blank, strip, subs
from glyphmill.functions.syllables import handwriting, keyboard, nfc, translate

LATIN = "latn_norm puj dp poj tl bp".split()
MERGED = "latn_norm puj dp poj tl bp han han_variants en zh_CN zh_TW source".split()
# Source factors, characters that end or mark a text.
SOURCE_WEIGHT = {"dieghv": "0.5"}
NUMERALS = "〇〡〢〣〤〥〦〧〨〩〪〭〮〯〫〬〰〱〲〳〴〵〶〷〸〹〺〻〼〽〾〿"
HAN_BREAKS = r"(?U)[，。、！？；：「」『』\"《》\s]+"
HAN_MARKS = '[。，、！？；：「」『』"《》]'


def present(columns: list[str]) -> Column:
    return F.exists(F.array(*[strip(blank(F.col(c))) for c in columns]), lambda v: v != "")


def pivot_of(row: dict[str, Column], order: list[str], lower_first: bool) -> Column:
    """The given pivot form, else that of the first system that has a value."""
    out = F.lit("")
    for system in reversed(order):
        value = F.lower(row[system]) if lower_first else row[system]
        out = F.when(row[system] != "", F.lower(translate(value, system.upper(), "LATN_NORM"))).otherwise(out)
    given = F.lower(row["latn_norm"])
    return F.when(given != "", given).otherwise(out)


def _columns(df: DataFrame) -> dict[str, Column]:
    return {c: blank(F.col(c)) if c in df.columns else F.lit("") for c in MERGED}


def merged_books(rows: DataFrame, variants: dict[str, list[str]], capitalized: list[str], with_variants: bool = True) -> DataFrame:
    """Rows of books or clippings in the merged form; seq is kept."""
    r = {c: strip(v) for c, v in _columns(rows).items()}
    r["puj"], r["poj"] = F.lower(r["puj"]), F.lower(r["poj"])
    spelled = F.array_join(T.compiled_variants(r["han"], variants), "|") if with_variants else F.lit("")
    r |= {"latn_norm": pivot_of(r, ["puj", "poj"], True), "han_variants": spelled, "en": T.lower_first(r["en"], capitalized), "source": T.source_name(r["source"])}
    return rows.select("seq", *[r[c].alias(c) for c in MERGED])


def merged_external(rows: DataFrame, capitalized: list[str]) -> DataFrame:
    """Rows of imported tables in the merged form. Rows whose romanization has no small letter or begins with none are left out."""
    r = _columns(rows)
    r |= {c: T.edges(r[c], ":#-.") for c in ("puj", "dp", "poj", "tl", "bp")} | {"han": T.edges(r["han"], ":#-")}
    r |= {c: T.bracket_with_han(T.repaired_nasal(r[c])) for c in ("poj", "tl")} | {c: strip(r[c]) for c in ("latn_norm", "en", "zh_CN", "zh_TW", "source")}
    keep = (r["poj"] == "") | (r["poj"].rlike("[a-z]") & r["poj"].rlike("^[A-Za-z]"))
    r |= {"latn_norm": pivot_of(r, ["puj", "poj", "tl", "dp"], False), "han_variants": F.lit(""), "en": T.lower_first(r["en"], capitalized), "source": T.source_name(r["source"])}
    return rows.where(keep).select("seq", *[r[c].alias(c) for c in MERGED])


def bad_syllable(syllable: Column) -> Column:
    """A toned syllable without a vowel or syllabic nasal, or with tone 4 or 8 and no stop at its end."""
    body, tone = (F.regexp_extract(syllable, r"^([a-z]+)(\d+)(\[.*\])?$", i) for i in (1, 2))
    left = F.regexp_replace(body, "(?<=.)(?:nnh|[ptkh])$", "")
    nucleus = body.rlike("[aeiou]") | left.rlike("(?:m|ng|n)$")
    return (body != "") & (~nucleus | (tone.isin("4", "8") & ~body.rlike("hnn$") & ~body.rlike("[ptkh]$")))


def valid(latn: Column) -> Column:
    return ~F.exists(F.split(latn, r"(?U)[-\s,]+", -1), bad_syllable)


def merged(*parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of all parts, Latin columns in normal form C. Sort them by latn_norm and seq to write them."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = rows.select("seq", *[(nfc(F.col(c)) if c in LATIN else blank(F.col(c))).alias(c) for c in MERGED]).withColumn("__ok", valid(F.col("latn_norm")))
    return rows.where("__ok").drop("__ok"), rows.where("not __ok").drop("__ok")


def loaded(rows: DataFrame) -> DataFrame:
    """Merged rows with ``_latn``: the pivot form, or that of the PUJ column with spaces for hyphens."""
    latn, puj = strip(blank(F.col("latn_norm"))), strip(blank(F.col("puj")))
    return rows.withColumn("_latn", F.when(latn != "", latn).when(puj != "", F.replace(keyboard(puj, "PUJ"), F.lit("-"), F.lit(" "))).otherwise(""))


def in_lexicon(systems: list[str] | None = None, need_han: bool = True) -> Column:
    gate = (F.col("_latn") != "") & ~F.col("_latn").rlike("[,.?!\"']") & (F.regexp_count("_latn", F.lit(r"(?U)\d")) <= 10)
    if need_han:
        gate = gate & (strip(blank(F.col("han"))) != "")
    return gate & present(systems) if systems else gate


def base_weight() -> Column:
    source, weight = strip(blank(F.col("source"))), F.lit(100)
    for name, factor in SOURCE_WEIGHT.items():
        weight = F.when(source == name, int(100 * float(factor))).otherwise(weight)
    return weight


def numbered(major: Column, minor: Column) -> Column:
    """A place as one number, for minor below 2^24 within major below 2^36; others raise. Numbers, unlike structs, are compared in the buffers
    of a hash aggregate."""
    fits = (minor >= 0) & (minor < 1 << 24) & (major >= 0) & (major < 1 << 36)
    return F.when(fits, major.cast("long") * (1 << 24) + minor).otherwise(F.raise_error(F.lit("place out of range")).cast("long"))


def placed(rows: DataFrame, k: Column, below: int) -> Column:
    """The place of part k, smaller than below, of a row: a number where seq is one."""
    whole = rows.schema["seq"].dataType.typeName() in ("integer", "long")
    return F.col("seq").cast("long") * below + k if whole else F.struct("seq", k)


def place_of(rows: DataFrame, k: Column, i: Column) -> Column:
    """The place of character i of part k of a row: one number where seq is one, so that hash aggregates hold it. Both are below 2^20, others
    raise."""
    if rows.schema["seq"].dataType.typeName() not in ("integer", "long"):
        return F.struct("seq", k, i)
    fits = (k >= 0) & (k < 1 << 20) & (i >= 0) & (i < 1 << 20)
    minor = F.when(fits, k.cast("long") * (1 << 20) + i).otherwise(F.raise_error(F.lit("place out of range")).cast("long"))
    return (F.col("seq").cast("decimal(20,0)") * F.lit(1 << 40).cast("decimal(14,0)") + minor.cast("decimal(20,0)")).cast("decimal(38,0)")


def first_and_more(events: DataFrame, keys: list[str]) -> DataFrame:
    """The weight of a key: that of its first event, and one for each later event; a column n says how many events a row stands for. Adds first,
    the place of the first event."""
    n = F.sum("n") if "n" in events.columns else F.count("*")
    return events.groupBy(*keys).agg((F.min_by("w", "at") + n - 1).cast("int").alias("weight"), F.min("at").alias("first"))


def entry_events(rows: DataFrame, systems: list[str] | None = None, need_han: bool = True) -> DataFrame:
    """Events (latn_norm, han, w, at, puj, dp, n): a row's own text, then its variants with half the weight each time, above zero. n rows
    that say the same are one event, that of the first of them; rows that come with a column n have been put together so."""
    own = T.unbracketed(strip(blank(F.col("han"))))
    own = F.when(own == "", T.untagged(strip(blank(F.col("puj"))))).otherwise(own)
    variants = blank(F.col("han_variants"))
    # Brackets end with their variant, so one replacement does for all.
    spelled = F.split(F.when(F.contains("variants", F.lit("[")), subs(F.col("variants"), (r"\[[^\]|]*\]", ""))).otherwise(F.col("variants")), r"\|", -1)
    kept = F.filter(F.transform(spelled, strip), lambda v: v != "")
    texts_ = rows.where(in_lexicon(systems, need_han)).select("seq", *["n"] * ("n" in rows.columns), F.col("_latn").alias("latn_norm"), base_weight().alias("base"), strip(blank(F.col("puj"))).alias("puj"), strip(blank(F.col("dp"))).alias("dp"), own.alias("own"), variants.alias("variants"))
    # Rows that say the same are one with their number and first place: variants are made once for each.
    if "n" not in rows.columns:
        texts_ = texts_.groupBy("latn_norm", "base", "puj", "dp", "own", "variants").agg(F.min("seq").alias("seq"), F.count("*").alias("n"))
    events = texts_.select("seq", "n", "latn_norm", "base", "puj", "dp", F.posexplode(F.concat(F.array("own"), kept)).alias("k", "han"))
    events = events.withColumn("w", F.expr("shiftright(base, k)")).where("han <> '' and (k = 0 or w > 0)")
    # Variants with k of 7 and more weigh nothing, so they are gone.
    return events.select("latn_norm", "han", "w", placed(rows, F.col("k"), 8).alias("at"), "k", "puj", "dp", "n")


def entries(rows: DataFrame, systems: list[str] | None = None, need_han: bool = True) -> DataFrame:
    """(latn_norm, han, weight, first, own, puj, dp): puj and dp from the first row that has the text itself, not as a variant; own is that row's place. What
    differs from row to row should be made of own: as puj it would keep rows that say the same apart."""
    return (
        entry_events(rows, systems, need_han)
        .groupBy("latn_norm", "han")
        .agg((F.min_by("w", "at") + F.sum("n") - 1).cast("int").alias("weight"), F.min("at").alias("first"), F.min(F.when(F.col("k") == 0, F.col("at"))).alias("own"), *[blank(F.min_by(c, F.when(F.col("k") == 0, F.col("at")))).alias(c) for c in ("puj", "dp")])
    )


def syllables_of(latn: Column) -> Column:
    words = F.split(F.translate(F.replace(latn, F.lit("…"), F.lit(" ")), "\"'", ""), r"(?U)[,\s-]+", -1)
    return F.filter(F.transform(words, lambda s: subs(s, ("[.?!;,]", ""))), lambda s: s != "")


def han_chars(han: Column) -> Column:
    """The characters of a text between its punctuation; a part that still has a mark is left out."""
    parts = F.filter(F.transform(F.split(han, HAN_BREAKS, -1), strip), lambda s: (s != "") & ~s.rlike(HAN_MARKS))
    return F.filter(F.split(F.array_join(parts, ""), "", -1), lambda c: c != "")


def char_events(rows: DataFrame, systems: list[str] | None = None) -> DataFrame:
    """Events (syllable, char, w, n, at) where a text has as many characters as syllables; variants of that length halve the weight. Rows that come
    with a column n stand for so many."""
    rows = rows.where((F.col("_latn") != "") & (strip(blank(F.col("han"))) != ""))
    rows = rows.where(present(systems)) if systems else rows
    own = F.replace(T.unbracketed(strip(F.col("han"))), F.lit("…"), F.lit(""))
    # Rows that say the same are one with their number and first place.
    said = [base_weight().alias("base"), F.col("_latn").alias("latn"), own.alias("own"), blank(F.col("han_variants")).alias("variants")]
    rows = rows.select("seq", "n", *said) if "n" in rows.columns else rows.groupBy(*said).agg(F.min("seq").alias("seq"), F.count("*").alias("n"))
    rows = rows.select("seq", "n", "base", syllables_of(F.col("latn")).alias("syl"), han_chars(F.col("own")).alias("main"), F.transform(F.filter(F.split("variants", r"\|", -1), lambda v: strip(v) != ""), lambda v: han_chars(T.unbracketed(strip(v)))).alias("more"))
    plain = lambda c: ~F.arrays_overlap(c, F.array(*map(F.lit, NUMERALS)))
    rows = rows.where((F.size("syl") > 0) & (F.size("syl") == F.size("main")) & plain(F.col("main")))
    fit = F.filter("more", lambda c: (F.size(c) == F.size("syl")) & plain(c))
    texts = rows.select("seq", "n", "base", "syl", F.posexplode(F.concat(F.array("main"), fit)).alias("k", "chars"))
    pairs = texts.select("seq", "n", "k", F.expr("shiftright(base, k)").alias("w"), F.posexplode(F.arrays_zip("syl", "chars")).alias("i", "x"))
    return pairs.select(F.col("x.syl").alias("syllable"), F.col("x.chars").alias("char"), "w", "n", place_of(rows, F.col("k"), F.col("i")).alias("at"))


def base_dictionary(lexicon: DataFrame) -> DataFrame:
    """(text, code, weight) of texts of two characters and more, the largest weight of each."""
    rows = lexicon.select(T.untagged(F.col("han")).alias("text"), T.spaced_code(T.untagged(F.col("latn_norm"))).alias("code"), "weight")
    return rows.where("code <> '' and length(text) > 1").groupBy("text", "code").agg(F.max("weight").alias("weight"))


def char_dictionary(chars: DataFrame) -> DataFrame:
    rows = chars.select(T.untagged(F.col("char")).alias("text"), T.spaced_code(T.untagged(F.col("syllable"))).alias("code"), "weight")
    return rows.where("text <> '' and code <> ''")


def bases(lexicon: DataFrame) -> DataFrame:
    """The toneless syllables in a lexicon."""
    parts = lexicon.select(F.explode(F.split("latn_norm", r"(?U)[\s-]+", -1)).alias("s"))
    return parts.select(F.regexp_extract("s", r"^([a-z]+?)(\d)$", 1).alias("base")).where("base <> '' and base not in ('p', 't', 'k', 'h', 'b', 'd', 'g')").distinct()


def toned(base: Column) -> Column:
    tones = F.when(base.rlike("[ptkh]$"), F.array(F.lit("4"), F.lit("8"))).otherwise(F.array(*map(F.lit, "123567")))
    return F.transform(tones, lambda t: F.concat(base, t))


def syllable_dictionary(lexicon: DataFrame, system: str) -> DataFrame:
    rows = bases(lexicon).select(F.explode(toned(F.col("base"))).alias("code"))
    return rows.select(translate(F.col("code"), "LATN_NORM", system).alias("text"), "code", F.lit(1).alias("weight")).where(strip(F.col("text")) != "")


def syllable_map(lexicon: DataFrame, system: str) -> DataFrame:
    """(code, text): every toned syllable that is written otherwise than it is typed, and toneless ones with their usual tone."""
    known = bases(lexicon)
    full = known.select(F.explode(toned(F.col("base"))).alias("code")).withColumn("text", translate(F.col("code"), "LATN_NORM", system))
    full = full.where((F.col("text") != "") & (F.lower(strip(F.col("text"))) != F.col("code")))
    bare = known.select(F.col("base").alias("code"), translate(F.concat("base", F.when(F.col("base").rlike("[ptkh]$"), "4").otherwise("1")), "LATN_NORM", system).alias("text"))
    return full.unionByName(bare.where("text <> ''").join(full, "code", "left_anti"))


def system_dictionary(lexicon: DataFrame, system: str) -> DataFrame:
    """(text, code, weight) of words of two syllables and more, in the system's form and, below it, as the source has it."""
    own = F.col(system.lower()) if system.lower() in ("puj", "dp") else F.lit("")
    words = lexicon.groupBy("latn_norm").agg(F.sum("weight").cast("int").alias("w"), blank(F.min_by(own, F.when(own != "", F.col("first")))).alias("given"))
    words = words.where(F.regexp_count("latn_norm", F.lit(r"(?U)\d")) > 1)
    given = T.untagged(F.when(strip(F.col("given")) != "", F.col("given")).otherwise(translate(F.col("latn_norm"), "LATN_NORM", system)))
    words = words.select("w", F.replace(T.untagged(F.col("latn_norm")), F.lit("-"), F.lit(" ")).alias("code"), given.alias("given")).where(strip(F.col("given")) != "")
    words = words.withColumn("usual", T.untagged(handwriting(keyboard(F.col("given"), system), system)))
    shown = lambda c: F.replace(c, F.lit("-"), F.lit("")) if system.upper() == "DP" else c
    two = F.array(F.when(strip(F.col("usual")) != "", F.struct(shown(F.col("usual")).alias("text"), (F.col("w") - 1).alias("weight"))), F.when(F.col("given") != F.col("usual"), F.struct(shown(F.col("given")).alias("text"), (F.col("w") - 2).alias("weight"))))
    return words.select("code", F.inline(F.filter(two, lambda x: x.isNotNull()))).groupBy("text", "code").agg(F.max("weight").alias("weight"))


def rom_map(lexicon: DataFrame, system: str) -> DataFrame:
    """(han, text): the first romanization of each text."""
    first = lexicon.groupBy("han").agg(F.min_by(F.struct("latn_norm", *[c for c in ("puj", "dp") if c in lexicon.columns]), "first").alias("x"))
    own = F.col(f"x.{system.lower()}") if system.lower() in ("puj", "dp") else F.lit("")
    return first.select("han", F.when(own != "", own).otherwise(translate(F.col("x.latn_norm"), "LATN_NORM", system)).alias("text"))


