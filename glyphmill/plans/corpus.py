"""Queries that apply lexicon operators to the driver's tables, whole, and the SQL that says the same in another way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glyphmill.functions import text as T
from glyphmill.operators import extract as X
from glyphmill.operators import lexicon as L
from glyphmill.operators import sections as S
from glyphmill.operators import validate as V
from glyphmill.plans.fixtures import ORACLES, QUERIES

WORD = r"[^\x20\x09-\x0D]+"


def query(sql: str):
    def keep(make):
        QUERIES[make.__name__] = make
        ORACLES[make.__name__] = sql
        return make

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, pos, word) of every word of the documents."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", F.posexplode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).alias("pos", "word"))


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, source, seq, n): every distinct word of the documents, apart by the source that tells its weight, its first place and how often it is there.
    What is made of words is then made once for each."""
    source = F.when(F.col("lang") == "de", "dieghv").otherwise("x")
    at = L.numbered(F.col("doc_id"), F.col("pos"))
    found = words(spark, sf_dir).groupBy("word", source.alias("source")).agg(F.min(at).alias("seq"), F.count("*").alias("n"))
    # n is never 0: a filter on what is made of a word that depends on n isn't moved below the sums, where it would run for each word's every place.
    return found.withColumn("word", F.when(F.col("n") > 0, F.col("word")))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.lines_of(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("file"), "text"))


SQL_WORDS = r"word AS (SELECT doc_id, lang, source, i - 1 AS pos, w[i] AS word FROM (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents), unnest(range(1, len(w) + 1)) AS t(i))"
SQL_LINES = r"line AS (SELECT CAST(doc_id AS VARCHAR) AS file, i - 1 AS line_no, l[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) AS t(i))"


@query(f"WITH {SQL_WORDS}, e AS (SELECT *, CASE WHEN lang = 'de' THEN 50 ELSE 100 END AS w, row_number() OVER (PARTITION BY lang, lower(word) ORDER BY doc_id, pos) AS n FROM word) SELECT lang, lower(word) AS word, CAST(sum(CASE WHEN n = 1 THEN w ELSE 1 END) AS INTEGER) AS weight FROM e GROUP BY ALL")
def a2_word_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = words(spark, sf_dir).select("lang", F.lower("word").alias("word"), F.when(F.col("lang") == "de", 50).otherwise(100).alias("w"), L.numbered(F.col("doc_id"), F.col("pos")).alias("at"))
    return L.first_and_more(events, ["lang", "word"]).select("lang", "word", "weight")


@query(f"WITH {SQL_WORDS}, n AS (SELECT lang, lower(word) AS word, count(*) AS n FROM word GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place FROM n) SELECT lang, word, n, CAST(place AS INTEGER) AS place FROM r WHERE place <= 20")
def o4_top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = words(spark, sf_dir).groupBy("lang", F.lower("word").alias("word")).agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))).where("place <= 20").select("lang", "word", "n", "place")


def _lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The syllable is made beside its word, before rows are: filters on it then read a column, where they would repeat its expression.
    docs = table(spark, sf_dir, "documents")
    each = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    both = F.transform(each, lambda w: F.struct(w.alias("word"), F.regexp_replace(F.lower(w), "[^a-z]+", "").alias("b")))
    both = F.transform(both, lambda x: F.struct(x["word"].alias("word"), F.when(x["b"] != "", F.concat(x["b"], F.lit("1"))).otherwise("").alias("_latn")))
    quoted = F.replace("word", F.lit("|"), F.lit("¦"))
    w = docs.select("doc_id", "lang", "source", F.posexplode(both).alias("pos", "x")).select("doc_id", "lang", "source", "pos", "x.*")
    return w.select(L.numbered(F.col("doc_id"), F.col("pos")).alias("seq"), "_latn", F.lit("").alias("puj"), F.lit("").alias("dp"), F.col("word").alias("han"), F.concat_ws("|", F.concat(F.lit("x"), quoted), F.lower(quoted)).alias("han_variants"), F.when(F.col("lang") == "de", "dieghv").otherwise(F.col("source")).alias("source"))


@query(
    f"WITH {SQL_WORDS}, r AS (SELECT *, regexp_replace(lower(word), '[^a-z]', '', 'g') || '1' AS latn, CASE WHEN lang = 'de' THEN 50 ELSE 100 END AS b FROM word WHERE regexp_matches(lower(word), '[a-z]')), "
    "e AS (SELECT latn, word AS han, b AS w, doc_id, pos, 0 AS k FROM r UNION ALL SELECT latn, 'x' || replace(word, '|', '¦'), b // 2, doc_id, pos, 1 FROM r UNION ALL SELECT latn, lower(replace(word, '|', '¦')), b // 4, doc_id, pos, 2 FROM r), "
    "c AS (SELECT latn, regexp_replace(han, '\\[[^\\]]*\\]', '', 'g') AS han, w, doc_id, pos, k FROM e), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY latn, han ORDER BY doc_id, pos, k) AS n FROM c WHERE han <> '') SELECT latn AS latn_norm, han, CAST(sum(CASE WHEN n = 1 THEN w ELSE 1 END) AS INTEGER) AS weight FROM n GROUP BY ALL"
)
def a3_variant_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.entries(_lexicon(spark, sf_dir)).select("latn_norm", "han", "weight")


@query(f"WITH {SQL_WORDS}, b AS (SELECT DISTINCT regexp_replace(lower(word), '[^a-z]', '', 'g') AS base FROM word) SELECT base || t AS code FROM (SELECT base, unnest(CASE WHEN regexp_matches(base, '[ptkh]$') THEN ['4', '8'] ELSE ['1', '2', '3', '5', '6', '7'] END) AS t FROM b WHERE base <> '' AND base NOT IN ('p', 't', 'k', 'h', 'b', 'd', 'g'))")
def a8_toned_syllables(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = _lexicon(spark, sf_dir).select(F.col("_latn").alias("latn_norm"))
    return L.bases(lexicon).select(F.explode(L.toned(F.col("base"))).alias("code"))


MARKED = [(" the ", " ~~the~~(THE) "), (" and ", " ++and++ "), (" of ", " ~~of~~ "), (" to ", " ~~to~~() ")]


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[~+]|\[替\]", "")
    for old, new in MARKED:
        text = F.replace(text, F.lit(old), F.lit(new))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", text.alias("text"))


def resolved(*news: str) -> str:
    """SQL of what is left of a marked text."""
    sql = "regexp_replace(coalesce(text, ''), '[~+]|\\[替\\]', '', 'g')"
    for (old, _), new in zip(MARKED, news, strict=True):
        sql = f"replace({sql}, '{old}', '{new}')"
    return sql


@query(f"SELECT doc_id, md5({resolved(' the ', '  ', ' of ', ' to ')}) AS digest FROM documents")
def p01_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(spark, sf_dir).select("doc_id", F.md5(T.original(F.col("text"))).alias("digest"))


@query(f"SELECT doc_id, md5({resolved(' THE ', ' and ', '  ', ' 〔〕 ')}) AS digest FROM documents")
def p02_modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(spark, sf_dir).select("doc_id", F.md5(T.modified(F.col("text"), "〔〕")).alias("digest"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(coalesce(text, ''), '\[\d+\]', '', 'g'), '[\s\x{b}\x{a0}\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) AS digest FROM documents")
def p03_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.clean(F.coalesce("text", F.lit("")))).alias("digest"))


@query("SELECT p_partkey, replace(p_type, ' ', '  ') AS code FROM part")
def p09_code_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.spaced_code(F.replace("p_type", F.lit(" "), F.lit("-"))).alias("code"))


@query("SELECT doc_id, source AS name FROM documents")
def p10_source_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.source_name(F.concat_ws(" > ", "source", "lang")).alias("name"))


@query("SELECT c_custkey, c_name AS name FROM customer")
def p11_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", T.edges(F.concat(F.lit(":-."), "c_name", F.lit("-:.")), ":-.").alias("name"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS was FROM orders")
def p24_unless_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", T.unless_equal(F.col("o_orderstatus"), F.lit("F")).alias("was"))


@query(f"WITH {SQL_LINES}, m AS (SELECT *, CASE WHEN starts_with(line, 'T') THEN line_no END AS head FROM line) SELECT file, CAST(line_no AS INTEGER) AS line_no, CAST(max(head) OVER (PARTITION BY file ORDER BY line_no) AS INTEGER) AS last_head FROM m")
def w1_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = lines(spark, sf_dir).withColumn("head", F.when(F.col("line").startswith("T"), F.col("line_no")))
    return marked.select("file", "line_no", X.filled(F.col("head")).alias("last_head"))


@query(
    f"WITH {SQL_LINES}, m AS (SELECT file, line_no, CASE WHEN starts_with(line, 'A') THEN '## ' || line ELSE regexp_replace(line, '^#', '♯') END AS line FROM line), "
    "s AS (SELECT *, sum(CASE WHEN starts_with(line, '## ') THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no) AS section_no FROM m) "
    "SELECT file, CAST(section_no AS BIGINT) AS section_no, CAST(min(line_no) AS INTEGER) AS first_line, CAST(max(line_no) AS INTEGER) AS last_line, md5(string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM s GROUP BY file, section_no HAVING section_no > 0 OR trim(string_agg(line, '')) <> ''"
)
def w2_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    headed = lines(spark, sf_dir).withColumn("line", F.when(F.col("line").startswith("A"), F.concat(F.lit("## "), "line")).otherwise(F.regexp_replace("line", "^#", "♯")))
    return S.sections(headed, 2).select("file", F.col("section_no").cast("long").alias("section_no"), "first_line", "last_line", F.md5("body").alias("digest"))


@query(f"WITH {SQL_LINES} SELECT file, CAST(line_no + 2 AS INTEGER) AS csv_row FROM line")
def w3_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select("file", (F.row_number().over(W.partitionBy("file").orderBy("line_no")) + 1).alias("csv_row"))


@query(f"WITH {SQL_WORDS} SELECT doc_id, count(*) AS n FROM word WHERE regexp_matches(lower(word), '[a-z]') AND NOT regexp_matches(word, '[,.?!\"'']') AND length(regexp_replace(word, '[^0-9]', '', 'g')) <= 10 GROUP BY doc_id")
def f1_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = words(spark, sf_dir).select("doc_id", F.when(F.lower("word").rlike("[a-z]"), F.col("word")).otherwise("").alias("_latn"), F.col("word").alias("han"))
    return rows.where(L.in_lexicon()).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(
    f"WITH {SQL_WORDS}, s AS (SELECT doc_id, regexp_replace(lower(word), '[^a-z]', '', 'g') AS b, CASE WHEN pos % 2 = 0 THEN '4' ELSE '1' END AS t FROM word), "
    "x AS (SELECT *, CASE WHEN regexp_matches(b, '^.+nnh$') THEN b[:-4] WHEN regexp_matches(b, '^.+[ptkh]$') THEN b[:-2] ELSE b END AS left_ FROM s WHERE b <> '') "
    "SELECT doc_id, count(*) AS n FROM x WHERE (regexp_matches(b, '[aeiou]') OR regexp_matches(left_, '(m|ng|n)$')) AND (t = '1' OR regexp_matches(b, '(hnn|[ptkh])$')) GROUP BY doc_id"
)
def f4_valid_syllables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = words(spark, sf_dir).select("doc_id", F.regexp_replace(F.lower("word"), "[^a-z]", "").alias("b"), F.when(F.col("pos") % 2 == 0, "4").otherwise("1").alias("t")).where("b <> ''")
    return rows.where(L.valid(F.concat("b", "t"))).groupBy("doc_id").agg(F.count("*").alias("n"))


@query(r"WITH c AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x{0}-\x{7f}\x{a0}-\x{24f}‘’“”–—…]')) AS c FROM documents) SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id")
def v2_english_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", F.size(V.odd_chars(F.col("text"), V.EN_CHAR)).cast("long").alias("n"))
    return found.where("n > 0")


@query(r"WITH c AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x{0}-\x{7f}]')) AS c FROM documents) SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id")
def v2_ascii_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", F.size(V.odd_chars(F.col("text"), r"^[\x00-\x7f]$")).cast("long").alias("n"))
    return found.where("n > 0")


@query("SELECT source AS file, count(*) AS rows, count(*) FILTER (lang = 'de') AS errors, count(*) FILTER (lang = 'fr') AS warnings FROM documents GROUP BY ROLLUP (source)")
def a1_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("file", F.col("source"))
    found = docs.where(F.col("lang").isin("de", "fr")).select("file", F.when(F.col("lang") == "de", "error").otherwise("warning").alias("level"))
    return V.totals(docs, found)


@query("SELECT event_type || ':' || CAST(user_id % 7 AS VARCHAR) AS kind, count(*) AS n FROM events GROUP BY ALL ORDER BY n DESC, kind LIMIT 20")
def a11_top_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "events").select(F.col("event_type").alias("field"), (F.col("user_id") % 7).cast("string").alias("kind"))
    return V.top_kinds(found)


@query("WITH u AS (SELECT 0 AS part, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 1, s_suppkey, s_name FROM supplier) SELECT part, id, name, CAST(row_number() OVER (PARTITION BY part ORDER BY name, id) AS INTEGER) AS place FROM u")
def u1_union_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.lit(0).alias("part"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit(1).alias("part"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b).withColumn("place", F.row_number().over(W.partitionBy("part").orderBy("name", "id")))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def u3_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_anti")


@query(f"WITH {SQL_WORDS}, b AS (SELECT DISTINCT regexp_replace(lower(word), '[^a-z]', '', 'g') AS base FROM word), t AS (SELECT base, CASE WHEN regexp_matches(base, '[ptkh]$') THEN '4' ELSE '1' END AS tone FROM b WHERE base <> '' AND base NOT IN ('p', 't', 'k', 'h', 'b', 'd', 'g')) SELECT base AS code FROM t WHERE base NOT IN (SELECT base || 's' FROM t)")
def u3_no_plural(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toneless syllables but those that are another with an s."""
    known = L.bases(_lexicon(spark, sf_dir).select(F.col("_latn").alias("latn_norm")))
    return known.join(known.select(F.concat("base", F.lit("s")).alias("base")), "base", "left_anti").select(F.col("base").alias("code"))


@query("SELECT o_orderkey, coalesce(c_mktsegment, '') AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def j3_left_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    return table(spark, sf_dir, "orders").join(known, "o_custkey", "left").select("o_orderkey", F.coalesce("segment", F.lit("")).alias("segment"))


@query("SELECT p_partkey, CASE WHEN regexp_extract(p_name, '^[a-zA-Z]+') IN ('Large', 'Small') THEN p_name ELSE lower(p_name[1]) || p_name[2:] END AS name FROM part")
def j4_p05_lower_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = T.lower_first(F.col("p_name"), ["Large", "Small"])
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


@query("SELECT n_name, r_name, part FROM nation, region, (VALUES ('x'), ('y')) AS t(part) WHERE n_regionkey = r_regionkey")
def x4_crossed(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    cells = table(spark, sf_dir, "nation").join(regions, "n_regionkey").withColumn("cell", F.lit("x | y"))
    return cells.select("n_name", "r_name", F.explode(X._alternatives(F.col("cell"))).alias("part"))


@query("SELECT l_returnflag AS text, l_linestatus AS code, CAST(max(l_linenumber) AS INTEGER) AS weight FROM lineitem GROUP BY ALL")
def a6_max_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("text"), F.col("l_linestatus").alias("code")).agg(F.max("l_linenumber").alias("weight"))


@query(
    f"WITH {SQL_WORDS}, r AS (SELECT regexp_replace(word, '^\\[([^\\]]+)\\]$', '\\1') AS text, regexp_replace(lower(word), '[^a-z]', '', 'g') || '1' AS code, CAST(pos % 7 AS INTEGER) AS weight FROM word WHERE regexp_matches(lower(word), '[a-z]') AND length(regexp_replace(word, '^\\[([^\\]]+)\\]$', '\\1')) > 1) "
    "SELECT text, code, max(weight) AS weight FROM r GROUP BY ALL"
)
def a6_base_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lexicon(spark, sf_dir).select("han", F.col("_latn").alias("latn_norm"), F.pmod(F.col("seq").bitwiseAND((1 << 24) - 1), F.lit(7)).cast("int").alias("weight"))
    return L.base_dictionary(rows)


@query(f"WITH {SQL_WORDS}, f AS (SELECT lower(word) AS word, doc_id, pos, row_number() OVER (PARTITION BY lower(word) ORDER BY doc_id, pos) AS n FROM word) SELECT word, doc_id, CAST(pos AS INTEGER) AS pos FROM f WHERE n = 1")
def a12_first_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = words(spark, sf_dir).select(F.lower("word").alias("word"), F.lit(1).alias("w"), L.numbered(F.col("doc_id"), F.col("pos")).alias("at"))
    first = L.first_and_more(events, ["word"])
    return first.select("word", F.shiftright("first", 24).alias("doc_id"), F.col("first").bitwiseAND((1 << 24) - 1).cast("int").alias("pos"))


@query(
    "WITH a AS (SELECT p_partkey, p_name, unnest(CASE WHEN contains(p_name, 'old plate') THEN [replace(p_name, 'old plate', x) FOR x IN ['old plate', 'OP', 'PLATE']] WHEN contains(p_name, 'old') THEN [p_name, replace(p_name, 'old', 'OLD')] ELSE [p_name] END) AS t FROM part), "
    "b AS (SELECT p_partkey, p_name, unnest(CASE WHEN contains(t, 'ring') THEN [t, replace(t, 'ring', 'RING')] ELSE [t] END) AS t FROM a) "
    "SELECT p_partkey, t AS spelled FROM b WHERE t <> p_name"
)
def j1_j2_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spellings of the names of parts by a table of variants that is part of the plan, one key inside another."""
    spelled = T.compiled_variants(F.col("p_name"), {"ring": ["RING"], "old plate": ["OP", "PLATE"], "old": ["OLD"]})
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(spelled).alias("spelled"))


@query(
    f"WITH {SQL_WORDS}, r AS (SELECT *, regexp_replace(lower(word), '[^a-z]', '', 'g') || '1' AS latn, CASE WHEN lang = 'de' THEN 50 ELSE 100 END AS b FROM word WHERE regexp_matches(lower(word), '[a-z]')), "
    "e AS (SELECT latn, word AS han, b AS w, doc_id, pos, 0 AS k FROM r UNION ALL SELECT latn, 'x' || replace(word, '|', '¦'), b // 2, doc_id, pos, 1 FROM r UNION ALL SELECT latn, lower(replace(word, '|', '¦')), b // 4, doc_id, pos, 2 FROM r), "
    "c AS (SELECT latn, regexp_replace(han, '\\[[^\\]]*\\]', '', 'g') AS han, w, doc_id, pos, k FROM e), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY latn, han ORDER BY doc_id, pos, k) AS n FROM c WHERE han <> '') "
    "SELECT latn AS latn_norm, han, CAST(sum(CASE WHEN n = 1 THEN w ELSE 1 END) AS INTEGER) AS weight, coalesce(arg_min('p' || doc_id || '-' || pos, doc_id * 16777216 + pos) FILTER (k = 0), '') AS puj FROM n GROUP BY ALL"
)
def a2_a3_a5_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of the documents' words and their variants; puj is the place of the first row that has the text itself, made of that row's number."""
    letters, quoted = F.regexp_replace(F.lower("word"), "[^a-z]+", ""), F.replace("word", F.lit("|"), F.lit("¦"))
    rows = counted(spark, sf_dir).select("seq", "n", "source", "word", letters.alias("b"), F.concat_ws("|", F.concat(F.lit("x"), quoted), F.lower(quoted)).alias("han_variants")).where("b <> ''")
    rows = rows.select("seq", "n", F.concat("b", F.lit("1")).alias("_latn"), F.lit("").alias("puj"), F.lit("").alias("dp"), F.col("word").alias("han"), "han_variants", "source")
    seq = F.shiftright("own", 3)
    place = F.concat(F.lit("p"), F.shiftright(seq, 24), F.lit("-"), seq.bitwiseAND((1 << 24) - 1))
    return L.entries(rows).select("latn_norm", "han", "weight", F.coalesce(place, F.lit("")).alias("puj"))


@query(
    f"WITH {SQL_WORDS}, r AS (SELECT regexp_replace(word, '\\[[^\\]]*\\]', '', 'g') AS han, lower(word) AS w, doc_id, pos FROM word WHERE regexp_matches(lower(word), '[a-z]')) "
    "SELECT han, arg_min(CASE WHEN w = 'to' THEN 'to' ELSE 'p' || doc_id || '-' || pos END, doc_id * 16777216 + pos) AS text FROM r WHERE han <> '' GROUP BY han"
)
def a10_rom_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first romanization of each word: its place, but for one word, whose form is translated from the pivot."""
    place = F.concat(F.lit("p"), F.shiftright("seq", 24), F.lit("-"), F.col("seq").bitwiseAND((1 << 24) - 1))
    rows = _lexicon(spark, sf_dir).withColumn("puj", F.when(F.lower("han") == "to", "").otherwise(place)).withColumn("han_variants", F.lit(""))
    return L.rom_map(L.entries(rows), "PUJ")


@query(
    "WITH b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[ptk][aiu][ptk]?')) AS b FROM documents), "
    "m AS (SELECT b, unnest(CASE WHEN length(b) = 3 THEN ['', '4', '8'] ELSE ['', '1', '2', '3', '5', '6', '7'] END) AS t FROM b), "
    "v(v, t, x) AS (VALUES ('a', '2', 'á'), ('a', '3', 'à'), ('a', '5', 'â'), ('a', '6', 'ǎ'), ('a', '7', 'ā'), ('i', '2', 'í'), ('i', '3', 'ì'), ('i', '5', 'î'), ('i', '6', 'ǐ'), ('i', '7', 'ī'), ('u', '2', 'ú'), ('u', '3', 'ù'), ('u', '5', 'û'), ('u', '6', 'ǔ'), ('u', '7', 'ū'), ('a', '8', 'a̍'), ('i', '8', 'i̍'), ('u', '8', 'u̍')) "
    "SELECT b || m.t AS code, b[1] || coalesce(x, b[2]) || b[3:] AS text FROM m LEFT JOIN v ON v.v = b[2] AND v.t = m.t"
)
def k12_a9_syllable_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The syllable map of the syllables of three stops and three vowels that the documents' texts hold."""
    found = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[ptk][aiu][ptk]?"), F.lit(0))
    each = table(spark, sf_dir, "documents").select(F.explode(found).alias("base")).distinct()
    return L.syllable_map(each.select(F.concat("base", F.when(F.length("base") == 3, "4").otherwise("1")).alias("latn_norm")), "POJ")
