"""Checks of the lexicon's fields: findings (file, row, field, level, kind, message), and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphmill.functions.columns import blank, let, subs
from glyphmill.functions.syllables import handwriting, keyboard, nfc

SYSTEMS = "latn_norm puj dp poj tl bp".split()
# Characters that the fields may hold.
HAN_CHAR = r"^[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{f900}-\x{faff}｜·‐‑‒–—―─│﹂﹁\x{200b}\x{3000}、。！（），．：；？\p{Lo}\p{Mn}\p{Po}\p{Pd}\p{Ps}\p{Pe}\p{Pf}\p{Pi}\p{Sk}\p{So}]$"
EN_CHAR = r"^[\x00-\x7f\x{a0}-\x{ff}\x{100}-\x{17f}\x{180}-\x{24f}‘’“”–—…]$"
LATIN_WORD = r"^[a-zA-ZÀ-ɏ̀-ͯḀ-ỿ͘⁰-ⁿ·\-'\d²³¹.?!,;:\[\]()、。]*$"


def _finding(level: str, kind: str, message: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), F.lit(kind).alias("kind"), message.alias("message"))


def odd_chars(value: Column, allowed: str) -> Column:
    """Findings for characters that a field doesn't allow. allowed: a pattern ``^[...]$``. Only texts that hold such a character are taken
    apart."""
    chars = F.transform(F.split(blank(value), "", -1), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    bad = F.filter(chars, lambda x: (x["c"] != "") & ~x["c"].rlike(f"(?s){allowed}"))
    found = F.transform(bad, lambda x: _finding("error", "char", F.concat(F.lit("pos "), x["i"].cast("string"), F.lit(": unexpected char "), x["c"])))
    fine = blank(value).rlike(rf"\A{allowed[1:-1]}*+\z")
    return F.when(fine, F.array().cast("array<struct<level:string,kind:string,message:string>>")).otherwise(found)


def latin(value: Column, system: str) -> Column:
    """Findings for characters outside a romanization, and for syllables that don't come back from their typed form."""
    words = F.filter(F.split(subs(blank(value), (r"\[[^\]]*\]", "")), r"(?U)[-\s]+", -1), lambda s: s != "")
    strange = F.transform(F.filter(words, lambda s: ~s.rlike(LATIN_WORD)), lambda s: _finding("warning", "non-latn char(s) in annotation context", s))
    back = F.transform(words, lambda s: let(keyboard(s, system), lambda k: F.struct(nfc(s).alias("s"), k.alias("k"), handwriting(k, system).alias("b"))))
    lost = F.transform(F.filter(back, lambda x: x["s"] != x["b"]), lambda x: _finding("warning", "roundtrip", F.concat_ws(" -> ", x["s"], x["k"], x["b"])))
    return F.concat(strange, lost)


def findings(rows: DataFrame, errors_only: bool = False, systems: list[str] | None = None) -> DataFrame:
    """rows: (file, row, han, en and columns of systems)."""
    checks = [("han", odd_chars(F.col("han"), HAN_CHAR)), ("en", odd_chars(F.col("en"), EN_CHAR))]
    checks += [(s, latin(F.col(s), s)) for s in systems or SYSTEMS if s in rows.columns]

    def of(field: str, found: Column) -> Column:
        return F.transform(found, lambda x: F.struct(F.lit(field).alias("field"), x["level"].alias("level"), x["kind"].alias("kind"), x["message"].alias("message")))

    every = F.concat(*[of(f, c) for f, c in checks if f in rows.columns])
    out = rows.select("file", "row", F.inline(every))
    return out.where("level = 'error'") if errors_only else out


def totals(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(file, rows, errors, warnings), and the same over all files where file is null."""
    each = rows.groupBy("file").agg(F.count("*").alias("rows")).join(found.groupBy("file").agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings")), "file", "left")
    return each.rollup("file").agg(F.sum("rows").alias("rows"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"), F.coalesce(F.sum("warnings"), F.lit(0)).alias("warnings"))


def top_kinds(found: DataFrame, most: int = 20) -> DataFrame:
    """The most frequent kinds of finding in romanizations."""
    rows = found.where(~F.col("field").isin("han", "en")).groupBy(F.concat_ws(":", "field", "kind").alias("kind")).agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "kind").limit(most)
