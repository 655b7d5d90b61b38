"""Queries over whole tables on forms of texts and weights of characters: normal forms, conversions by table, functions in SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.functions import normal_form as N
from glyphmill.functions import sql as Q
from glyphmill.functions.systems import named
from glyphmill.operators import conversion as C
from glyphmill.operators import lexicon as L
from glyphmill.plans.corpus import SQL_WORDS, counted, query, table, words
from glyphmill.sources import readers as R
from glyphmill.sources.shared import kept, shared_folder

# Fixed value: letters of the documents' languages, each with what it is composed of; and marks out of order or that join nothing.
APART = [("é", "é"), ("è", "è"), ("ê", "ê"), ("à", "à"), ("á", "á"), ("ä", "ä"), ("í", "í"), ("ó", "ó"), ("ö", "ö"), ("ú", "ú"), ("ü", "ü"), ("ñ", "ñ"), ("ç", "ç"), ("É", "É"), ("Ä", "Ä")]
ODD = [("s ", "ṩ "), ("t ", "t́́ "), ("re", "Å̧̂"), ("th", "한"), ("ou", "각́"), ("an", "क़ো")]


def _apart_sql(text: str) -> str:
    for old, new in APART + ODD:
        text = f"replace({text}, '{old}', '{new}')"
    return text


@query(f"SELECT doc_id, md5(nfc_normalize({_apart_sql('''coalesce(text, '')''')})) AS digest FROM documents")
def p18_normal_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with letters taken apart, marks out of order, Hangul in parts and letters that don't stay, put in normal form C."""
    text = F.coalesce("text", F.lit(""))
    for old, new in APART + ODD:
        text = F.replace(text, F.lit(old), F.lit(new))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text")).select("doc_id", F.md5(N.nfc(F.col("text"))).alias("digest"))


@query(
    f"""WITH {SQL_WORDS}, w AS (SELECT doc_id, pos, lang, regexp_replace(lower(word), '[^a-z]', '', 'g') AS b FROM word),
f AS (SELECT doc_id, pos, 0 AS k, CASE WHEN lang = 'de' THEN 50 ELSE 100 END AS w, b, b AS h FROM w WHERE b <> '' UNION ALL SELECT doc_id, pos, 1, CASE WHEN lang = 'de' THEN 25 ELSE 50 END, b, reverse(b) FROM w WHERE b <> ''
  UNION ALL SELECT doc_id, pos, 2, CASE WHEN lang = 'de' THEN 12 ELSE 25 END, b, upper(b) FROM w WHERE b <> ''),
e AS (SELECT b[i] || '1' AS syllable, h[i] AS char, w, row_number() OVER (PARTITION BY b[i], h[i] ORDER BY doc_id, pos, k, i) AS n FROM f, unnest(range(1, length(b) + 1)) AS t(i))
SELECT syllable, char, CAST(sum(CASE WHEN n = 1 THEN w ELSE 1 END) AS INTEGER) AS weight FROM e GROUP BY ALL"""
)
def a4_char_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of characters beside their syllables: each letter of a word is a syllable, its text and two variants are as long."""
    b = F.regexp_replace(F.lower("word"), "[^a-z]+", "")
    rows = counted(spark, sf_dir).groupBy(b.alias("han"), "source").agg(F.min("seq").alias("seq"), F.sum("n").alias("n")).where("han <> ''")
    latn = F.array_join(F.transform(F.split("han", ""), lambda c: F.concat(c, F.lit("1"))), " ")
    rows = rows.select("seq", "n", latn.alias("_latn"), "han", F.concat_ws("|", F.reverse("han"), F.upper("han")).alias("han_variants"), "source")
    return L.first_and_more(L.char_events(rows), ["syllable", "char"]).select("syllable", "char", "weight")


@query(f"WITH {SQL_WORDS}, d AS (SELECT coalesce(lang, 'none') AS lang, 'x' || lower(word) || 'x' AS text, count(*) AS n FROM word GROUP BY ALL) SELECT lang, text, CAST(n AS INTEGER) AS weight, CAST(row_number() OVER (PARTITION BY lang ORDER BY text) + 2 AS INTEGER) AS line_no FROM d")
def s7_split_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each language, written as a dictionary file and read back in splits of 100 KB."""
    text = F.concat(F.lit("x"), F.lower("word"), F.lit("x"))
    found = words(spark, sf_dir).groupBy(F.coalesce("lang", F.lit("none")).alias("lang"), text.alias("text")).agg(F.count("*").cast("int").alias("n"))
    entries = found.select("lang", F.lit(1).alias("part"), "text", F.concat_ws("\t", "text", F.lit("x1"), F.col("n").cast("string")).alias("value"))
    head = found.select("lang").distinct().select("lang", F.explode(F.array(*[F.struct(F.lit(0).alias("part"), F.lit(str(i)).alias("text"), F.lit(x).alias("value")) for i, x in enumerate(("# words", "---", "..."))])).alias("x")).select("lang", "x.*")
    at = f"{shared_folder(spark)}/dictionaries-{uuid.uuid4().hex}"
    head.unionByName(entries).repartition("lang").sortWithinPartitions("lang", "part", "text").select("lang", "value").write.partitionBy("lang").text(at)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = [kept(R.dictionary(spark, f"{at}/lang={x['lang']}", fields=3).select(F.lit(x["lang"]).alias("lang"), "text", "weight", "line_no"), "words") for x in found.select("lang").distinct().collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    return reduce(DataFrame.unionByName, rows)


_PIVOT_INITIALS = "chh|ch|ph|th|kh|ng|p|b|m|t|n|l|k|g|h|s|j"
_TL_INITIALS = "tsh|ts|ph|th|kh|ng|p|b|m|t|n|l|k|g|h|s|j"


def _parts_sql(name: str, source: str, initials: str, endings: str = "nnh|ng|nn|p|t|k|h|m|n") -> str:
    """(i, v, e): initial, vowel and ending of c; c is an initial alone, or has the longest ending and then the longest initial that fit."""
    alone = f"regexp_full_match(c, '{initials}')"
    return (
        f"{name}0 AS (SELECT *, CASE WHEN {alone} THEN '' ELSE regexp_extract(c, '^(.+?)({endings})$', 2) END AS e FROM {source}), "
        f"{name}1 AS (SELECT *, CASE WHEN {alone} THEN c ELSE regexp_extract(c[1:length(c) - length(e)], '^(?:{initials})') END AS i FROM {name}0), "
        f"{name} AS (SELECT *, c[length(i) + 1:length(c) - length(e)] AS v FROM {name}1)"
    )


@query(
    "WITH w AS (SELECT word, word AS c, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS word FROM documents) GROUP BY word), "
    + _parts_sql("a", "w", _TL_INITIALS)
    + ", p AS (SELECT word, n, CASE i WHEN 'ts' THEN 'ch' WHEN 'tsh' THEN 'chh' ELSE i END || v || e AS c FROM a), "
    + _parts_sql("b", "p", _PIVOT_INITIALS)
    + " SELECT word, n, c || '1' AS pivot, i || CASE v WHEN 'ou' THEN 'oo' WHEN 'ua' THEN 'oa' WHEN 'ue' THEN 'oe' ELSE v END || e || '1' AS poj FROM b"
)
def t13_functions_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' words as typed syllables of one system in another's letters, by functions of SQL."""
    Q.define(spark, "TL", "POJ")
    return spark.sql(
        f"""SELECT word, n, tl_to_pivot(concat(word, '1')) AS pivot, pivot_to_poj(tl_to_pivot(concat(word, '1'))) AS poj
        FROM (SELECT word, count(*) AS n FROM (SELECT explode(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+', 0)) AS word FROM parquet.`{sf_dir}/documents.parquet`) GROUP BY word)"""
    )


def _cases(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())} ELSE {column} END"


_TO_DP = [_cases(c, named("DP").from_pivot[k]) for c, k in (("i", "initial"), ("v", "vowel"), ("e", "ending"))]


@query(
    "WITH w AS (SELECT DISTINCT word, word AS c FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS word FROM documents)), "
    + _parts_sql("a", "w", _TL_INITIALS)
    + ", p AS (SELECT word, CASE i WHEN 'ts' THEN 'ch' WHEN 'tsh' THEN 'chh' ELSE i END || v || e AS c FROM a), "
    + _parts_sql("b", "p", _PIVOT_INITIALS, "nnh|ng|nn|p|t|k|h|m|n|b|d|g")
    + f" SELECT word, regexp_replace({' || '.join(_TO_DP)}, 'nn$', 'ⁿ') || CASE WHEN regexp_matches(word, '[ptkh]$') THEN '⁴' ELSE '¹' END AS dp FROM b"
)
def t10_words_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' runs of letters, read as syllables of one system, in another's marked form: each distinct syllable is converted once."""
    runs = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    found = table(spark, sf_dir, "documents").select(F.explode(runs).alias("word")).distinct()
    return C.converted(found, "word", "TL", "DP", "dp")


_TL_TONES = {"á": ("a", 2), "à": ("a", 3), "â": ("a", 5), "ā": ("a", 7), "é": ("e", 2), "è": ("e", 3), "ê": ("e", 5), "í": ("i", 2), "ó": ("o", 2), "ò": ("o", 3), "ô": ("o", 5), "ú": ("u", 2), "ù": ("u", 3)}
_PLAIN = "w"
for _mark, (_vowel, _tone) in _TL_TONES.items():
    _PLAIN = f"replace({_PLAIN}, '{_mark}', '{_vowel}')"


@query(
    "WITH d AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-záàâéèêíóòôúù]+')) AS w FROM documents)), "
    f"m AS (SELECT w, {_PLAIN} AS plain, list_last(regexp_extract_all(w, '[áàâéèêíóòôúù]')) AS mark FROM d), "
    f"t AS (SELECT w, plain, CASE {' '.join(f"WHEN mark = '{k}' THEN {t}" for k, (_, t) in _TL_TONES.items())} ELSE 1 END AS tone FROM m) "
    "SELECT w AS word, plain || CASE WHEN regexp_matches(plain, '[ptkh]$') THEN CASE WHEN tone > 1 THEN 8 ELSE 4 END ELSE tone END AS typed FROM t"
)
def t4_words_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' runs of letters, plain and marked ones, as typed syllables: marked vowels are read by the reverse index."""
    runs = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-záàâéèêíóòôúù]+"), F.lit(0))
    found = table(spark, sf_dir, "documents").select(F.explode(runs).alias("word")).distinct()
    return C.typed(found, "word", "TL", "typed")
