"""Records out of lines, cells and readings: DataFrame to DataFrame.

Lines come as (file, line_no, line). Nothing depends on the order of rows; what depends on the order of lines takes it from line_no,
within one file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.functions.columns import blank, let, lookup, strip, subs
from glyphmill.functions.syllables import marked_syllable, nfc, translate
from glyphmill.operators.ranges import filled_down

ENTRY = "puj puj_orig poj poj_orig han han_orig en en_orig zh_TW zh_CN source".split()
EXTERNAL = "puj dp poj tl bp han han_variants en zh_CN zh_TW source".split()
BOOK_HAN = T.HAN_WIDE + r"\x{3000}-\x{303f}"
CORRECTION = r"~~[^~]*~~\([^)]*\)"

EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def extractor(*stems: str):
    """Registers a function for files of these stems."""

    def keep(function: Callable[[DataFrame], DataFrame]):
        EXTRACTORS.update(dict.fromkeys(stems, function))
        return function

    return keep


def extractor_for(stem: str) -> Callable[[DataFrame], DataFrame] | None:
    return EXTRACTORS.get(stem)


def lines_of(texts: DataFrame) -> DataFrame:
    """(file, text) to (file, line_no, line)."""
    return texts.select("file", F.posexplode(F.split(blank(F.col("text")), "\n", -1)).alias("line_no", "line"))


def filled(value: Column, by: str = "file", order: str = "line_no") -> Column:
    """The last value that isn't null, up to this row, as a column; it brings a file to one task. filled_down() doesn't."""
    return F.last(value, ignorenulls=True).over(W.partitionBy(by).orderBy(order).rowsBetween(W.unboundedPreceding, 0))


def _section(line: Column) -> Column:
    return F.when(strip(line).startswith("#"), strip(subs(strip(line), ("^#+", ""))))


def _labelled(section: Column) -> Column:
    return F.when(blank(section) != "", F.concat_ws(" > ", "file", section)).otherwise(F.col("file"))


@extractor("001_Handbook_of_the_Swatow_Vernacular")
def handbook(lines: DataFrame) -> DataFrame:
    """Entries of a handbook whose items are lines ``- **bold** romanization ... ... ... rest``. With Han in the bold part the line is a
    lesson, else a word of vocabulary; a ditto mark stands for the headword before."""
    mark = r"\s*\.\.\.\s*\.\.\.\s*\.\.\.\s*"
    item = lines.select("file", "line_no", _section(F.col("line")).alias("own_section"), F.regexp_extract("line", r"^(?U)\s*- \*\*(.+?)\*\*\s*(.*)", 1).alias("bold"), F.regexp_extract("line", r"^(?U)\s*- \*\*(.+?)\*\*\s*(.*)", 2).alias("rest"))
    halves = F.split("rest", f"(?U){mark}", 2)
    item = item.withColumn("is_item", (F.col("bold") != "") & (F.size(halves) == 2) & F.col("own_section").isNull())
    item = item.select("*", strip(F.get(halves, F.lit(0))).alias("puj_raw"), strip(F.get(halves, F.lit(1))).alias("tail"), T.modified(F.col("bold")).rlike(f"[{BOOK_HAN}]").alias("lesson"), F.col("bold").startswith("„").alias("ditto"))
    base = lambda x: F.when(strip(F.get(F.split(x, "[,(]", -1), F.lit(0))) != "", strip(F.get(F.split(x, "[,(]", -1), F.lit(0))))
    own = F.col("is_item") & ~F.col("lesson") & ~F.col("ditto")
    item = item.withColumn("base_mod", F.when(own, base(T.clean(T.modified(F.col("bold")))))).withColumn("base_orig", F.when(own, base(T.clean(T.original(F.col("bold"))))))
    item = filled_down(item, "file", "line_no", section=F.col("own_section"), last_mod=F.col("base_mod"), last_orig=F.col("base_orig"))
    item = item.where("is_item").withColumns({c: blank(F.col(c)) for c in ("last_mod", "last_orig")})

    qualifier = strip(F.substring("bold", 2, 1 << 30))
    qualifier_orig = strip(F.substring(T.original(F.col("bold")), 2, 1 << 30))
    en = F.when(F.col("lesson"), T.clean(T.modified(F.col("tail")))).when(F.col("ditto"), F.when(qualifier != "", F.concat("last_mod", F.lit(", "), T.modified(qualifier))).otherwise(F.col("last_mod"))).otherwise(T.clean(T.modified(F.col("bold"))))
    en_orig = F.when(F.col("lesson"), T.clean(T.original(F.col("tail")))).when(F.col("ditto"), F.when(qualifier_orig != "", F.concat("last_orig", F.lit(", "), qualifier_orig)).otherwise(F.col("last_orig"))).otherwise(T.clean(T.original(F.col("bold"))))
    chunks = F.filter(F.transform(F.split(F.when(F.col("lesson"), F.col("bold")).otherwise(F.col("tail")), "  +", -1), strip), lambda c: c != "")
    bare = subs(F.col("puj_raw"), (CORRECTION, ""))
    by_comma = T.split_outside(F.col("puj_raw"), ",")
    puj = F.when(F.contains(bare, F.lit(";")), T.split_outside(F.col("puj_raw"), ";")).when(F.exists(by_comma, lambda p: F.contains(p, F.lit(" "))), F.array(strip(F.col("puj_raw")))).otherwise(by_comma)
    item = item.select("file", "line_no", "section", "puj_raw", en.alias("en"), en_orig.alias("en_orig"), chunks.alias("chunks"), puj.alias("parts"))

    pair = lambda h, p: F.struct(h.alias("h"), p.alias("p"))
    n_parts, n_chunks = F.size("parts"), F.size("chunks")
    found = (
        F.when((n_parts == n_chunks) & (n_chunks > 1), F.zip_with("chunks", "parts", pair))
        .when((n_parts > 1) & (n_chunks == 1), F.transform("parts", lambda p: pair(F.get("chunks", F.lit(0)), p)))
        .otherwise(F.transform("chunks", lambda h: pair(h, F.col("puj_raw"))))
    )
    rows = item.select("file", "line_no", "section", "en", "en_orig", F.posexplode(found).alias("part_no", "x"))
    none = F.lit("")
    values = {
        "puj": T.clean(T.modified(F.col("x.p"))), "puj_orig": T.clean(T.original(F.col("x.p"))), "poj": none, "poj_orig": none, "han": T.clean(T.modified(F.col("x.h"))), "han_orig": T.clean(T.original(F.col("x.h"))),
        "en": F.col("en"), "en_orig": F.col("en_orig"), "zh_TW": none, "zh_CN": none, "source": _labelled(F.col("section")),
    }
    return rows.select("file", "line_no", "part_no", *[values[c].alias(c) for c in ENTRY])


@extractor("002_English-Chinese_Vocabulary_of_the_Vernacular_Or_Spoken_Language_of_Swatow")
def vocabulary(lines: DataFrame) -> DataFrame:
    """Entries of a vocabulary whose items are lines ``**word**, glosses``, with contexts in italics."""
    line = subs(strip(F.col("line")), (r"[&c.]+$", ""))
    item = lines.select("file", "line_no", F.when(line.startswith("#"), strip(subs(line, ("^#+", "")))).alias("own"), F.regexp_extract(line, r"^\*\*(.+?)\*\*,(?U)\s*(.*)", 1).alias("word"), F.regexp_extract(line, r"^\*\*(.+?)\*\*,(?U)\s*(.*)", 2).alias("rest"))
    item = filled_down(item, "file", "line_no", section=F.col("own")).where("word <> '' and own is null")
    item = item.select("file", "line_no", "section", strip(F.col("word")).alias("word"), strip(F.col("rest")).alias("rest")).where("rest <> ''")
    rest = subs(F.replace(F.col("rest"), F.lit("..."), F.lit("…")), (r"\.+$", ""))
    groups = item.select("file", "line_no", "section", "word", F.posexplode(F.split(rest, r"(?U)\.\s+(?=\*)", -1)).alias("group_no", "g")).where("g <> ''")
    subgroups = groups.select("file", "line_no", "section", "word", "group_no", F.posexplode(F.split(strip(F.col("g")), r"(?U);\s+(?=\*)", -1)).alias("sub_no", "s")).withColumn("s", strip(F.col("s"))).where("s <> ''")
    qualified = r"^([a-zA-Z][a-zA-Z ]*?),(?U)\s*\*(.+?)\*\s*,\s*(.*)"
    part = lambda p, i: strip(F.regexp_extract("s", p, i))
    comma, space = r"^\*(.+?)\*(?U)\s*,\s*(.*)", r"^\*(.+?)\*(?U)\s+(.*)"
    ascii_only = lambda x: ~x.rlike(r"[^\x00-\x7f]")
    is_q = F.col("s").rlike(qualified) & ((part(qualified, 3) != "") | ~ascii_only(part(qualified, 2)))
    context = F.when(F.col("s").rlike(comma), F.struct(part(comma, 1).alias("c"), part(comma, 2).alias("t"))).when(F.col("s").rlike(space), F.struct(part(space, 1).alias("c"), part(space, 2).alias("t")))
    en = F.when(is_q & ascii_only(part(qualified, 2)), F.concat_ws(", ", "word", part(qualified, 1), part(qualified, 2))).when(is_q, F.concat_ws(", ", "word", part(qualified, 1))).when(context.isNotNull(), F.concat_ws(", ", F.col("word"), context["c"])).otherwise(F.col("word"))
    said = F.when(is_q & ascii_only(part(qualified, 2)), part(qualified, 3)).when(is_q, F.concat_ws("; ", part(qualified, 2), part(qualified, 3))).when(context.isNotNull(), context["t"]).otherwise(F.col("s"))
    said = subgroups.select("file", "line_no", "section", "group_no", "sub_no", en.alias("en"), said.alias("said")).where("said <> '' and not startswith(said, 'see ')")
    rows = said.select("file", "line_no", "section", "group_no", "sub_no", "en", F.posexplode(F.split(F.replace("said", F.lit("*"), F.lit("")), ";", -1)).alias("part_no", "p"))
    rows = rows.withColumn("p", strip(subs(strip(F.col("p")), (r"(?iU)\.\s+(?:and\s+)?see\s+\w[\w\s]*", "")))).where("p <> ''")
    none = F.lit("")
    values = dict.fromkeys(ENTRY, none) | {"puj": T.clean(F.col("p")), "en": T.clean(F.col("en")), "source": _labelled(F.col("section"))}
    return rows.select("file", "line_no", "group_no", "sub_no", "part_no", *[values[c].alias(c) for c in ENTRY])


def _alternatives(cell: Column, mark: str = r"\|") -> Column:
    parts = F.filter(F.transform(F.split(blank(cell), mark, -1), strip), lambda p: p != "")
    return F.when(F.size(parts) == 0, F.array(strip(blank(cell)))).otherwise(parts)


def clippings(rows: DataFrame, source: Column) -> DataFrame:
    """Every combination of the alternatives of a clipping's cells. The source's prefix names the romanization; others give no rows."""
    rows = rows.select("*", source.alias("__source")).withColumn("__prefix", F.get(F.split("__source", r"\.", -1), F.lit(0)))
    rows = rows.where(F.col("__prefix").isin("teochew", "hokkien"))
    rows = rows.withColumn("__latn", F.explode(_alternatives(F.col("latn_norm")))).withColumn("__han", F.explode(_alternatives(F.col("han")))).withColumn("__zh", F.explode(_alternatives(F.col("zh_TW"))))
    spoken = lambda prefix, system: F.when((F.col("__prefix") == prefix) & (F.col("__latn") != ""), F.lower(translate(F.col("__latn"), "LATN_NORM", system))).otherwise("")
    none = F.lit("")
    values = dict.fromkeys(ENTRY, none) | {"puj": spoken("teochew", "PUJ"), "poj": spoken("hokkien", "POJ"), "han": F.col("__han"), "en": strip(blank(F.col("en"))), "zh_TW": F.col("__zh"), "zh_CN": strip(blank(F.col("zh_CN"))), "source": F.col("__source")}
    return rows.select(*[values[c].alias(c) for c in ENTRY])


def cycled(a: Column, b: Column, names: tuple[str, str]) -> Column:
    """Pairs of two lists, the shorter begun again until the longer ends."""
    n = F.greatest(F.size(a), F.size(b))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(a, i % F.size(a)).alias(names[0]), F.get(b, i % F.size(b)).alias(names[1])))


def word_table(rows: DataFrame, source: Column) -> DataFrame:
    """Entries of a word table with columns PojUnicode, KipUnicode, HanLoTaibunPoj, HanLoTaibunKip, HoaBun, EngBun; any may be missing."""
    col = lambda c: strip(blank(F.col(c))) if c in rows.columns else F.lit("")
    ready = lambda c: nfc(T.annotations(T.repaired_syllables(col(c))))
    rows = rows.where(~subs(col("PojUnicode"), (r"\[[^\]]*\]|\([^)]*\)", "")).rlike(f"[{T.HAN}]"))
    mixed = F.when(col("HanLoTaibunPoj") != "", col("HanLoTaibunPoj")).otherwise(col("HanLoTaibunKip"))
    han = F.when(T.han_only(mixed) == F.replace(mixed, F.lit(" "), F.lit("")), T.han_only(mixed)).otherwise("")
    rows = rows.select(ready("PojUnicode").alias("p"), ready("KipUnicode").alias("k"), han.alias("h"), col("EngBun").alias("e"), col("HoaBun").alias("z"), source.alias("s")).where("p <> '' or k <> ''")
    slash = lambda c: let(F.filter(F.transform(F.split(c, "/", -1), strip), lambda x: x != ""), lambda x: F.when(F.size(x) == 0, F.array(F.lit(""))).otherwise(x))
    rows = rows.select("h", "e", "z", "s", F.inline(cycled(slash(F.col("p")), slash(F.col("k")), ("poj", "tl"))))
    values = dict.fromkeys(EXTERNAL, F.lit("")) | {"poj": F.col("poj"), "tl": F.col("tl"), "han": F.col("h"), "en": F.col("e"), "zh_TW": F.col("z"), "source": F.col("s")}
    return rows.select(*[values[c].alias(c) for c in EXTERNAL])


def readings(rows: DataFrame, source: Column) -> DataFrame:
    """Entries of a character dictionary's (text, code) rows."""
    values = dict.fromkeys(EXTERNAL, F.lit("")) | {"dp": T.peng_im(strip(F.col("code"))), "han": strip(F.col("text")), "source": source}
    return rows.where(strip(F.col("text")) != "").select(*[values[c].alias(c) for c in EXTERNAL])


def syllabary(lines: DataFrame) -> DataFrame:
    """(latn_norm, puj, han) of a Markdown syllabary: tables by rime, rows by initial, groups ``\\[tone\\]`` of characters."""
    line = strip(F.col("line"))
    cells = F.filter(F.transform(F.split(line, r"\|", -1), strip), lambda c: c != "")
    table = lines.where(line.startswith("|") & ~line.startswith("|--------")).select("file", "line_no", cells.alias("cells")).where("size(cells) > 0")
    first = F.get("cells", F.lit(0))
    table = table.withColumn("own", F.when(first.rlike(r"\*\*[^*]+\*\*"), strip(F.regexp_extract(first, r"\*\*([^*]+)\*\*", 1))))
    table = filled_down(table, "file", "line_no", rime=F.col("own")).where(F.col("own").isNull() & F.col("rime").isNotNull() & first.rlike("^[a-zA-Z∅]+$"))
    groups = table.select("rime", first.alias("initial"), F.explode(F.regexp_extract_all(blank(F.get("cells", F.lit(1))), F.lit(r"\\\[\d\\\].*?(?=\\\[|$)"), F.lit(0))).alias("g"))
    rows = groups.select("rime", F.when(F.col("initial") == "∅", "").otherwise(F.col("initial")).alias("initial"), F.regexp_extract("g", r"\\\[(\d)", 1).alias("tone"), F.explode(T.syllabary_han(F.col("g"))).alias("han"))
    norm = F.concat(lookup({"ts": "ch", "tsh": "chh", "z": "j"}, F.col("initial")), "rime", "tone")
    return rows.select(F.replace(norm, F.lit("ⁿ"), F.lit("nn")).alias("latn_norm"), marked_syllable(F.concat("initial", "rime", "tone"), "PUJ").alias("puj"), "han")
