"""Queries that go through files: sources read what was put there, sinks write and their files are read back. What must come out stands in
the SQL only."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import extract as X
from glyphmill.operators import lexicon as L
from glyphmill.operators import ranges as G
from glyphmill.operators import sections as S
from glyphmill.operators import validate as V
from glyphmill.plans.corpus import SQL_WORDS, marked, query, resolved, table, words
from glyphmill.plans.fixtures import case
from glyphmill.sources import engine, external, readers, writers


def folder(spark: SparkSession) -> str:
    """A new folder's path below spark.checkpoint.dir, or, where all runs in one process and that is unset, a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="glyphmill-")
    return f"{at.rstrip('/')}/files-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, text: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


@case("s1_markdown", "file text", [("a", "# A\nx"), ("b", "y")])
def _(spark):
    at = folder(spark)
    for name, text in (("a.md", "# A\nx"), ("b.md", "y"), ("README.md", "no"), ("c.txt", "no")):
        put(spark, f"{at}/{name}", text)
    return readers.markdown(spark, at)


@case("s2_extracted_by_stem", "stem puj en", [("001_Handbook_of_the_Swatow_Vernacular", "tsek", "One"), ("other", "", "")])
def _(spark):
    at = folder(spark)
    put(spark, f"{at}/001_Handbook_of_the_Swatow_Vernacular.md", "# L\n- **一** tsek ... ... ... One")
    put(spark, f"{at}/other.md", "- **一** tsek ... ... ... One")
    rows = X.lines_of(readers.markdown(spark, at))
    stems = [r["file"] for r in rows.select("file").distinct().collect()]
    out = None
    for s in stems:
        own = X.extractor_for(s)
        one = own(rows.where(F.col("file") == s)).select(F.lit(s).alias("stem"), "puj", "en") if own else spark.createDataFrame([(s, "", "")], "stem string, puj string, en string")
        out = one if out is None else out.unionByName(one)
    return out


@case("s3_csv", "file a b more", [("t", "x,y", 'say "hi"', ""), ("t", "", "two\nlines", "")])
def _(spark):
    at = folder(spark)
    put(spark, f"{at}/t.csv", 'a,b\n"x,y","say ""hi"""\n,"two\nlines"\n')
    return readers.table(spark, f"{at}/t.csv", ["a", "b", "more"])


@case("s7_dictionary", "file text code weight", [("w.dict.yaml", "食", "ziah8", 3), ("w.dict.yaml", "飯", "bng7", 1)])
def _(spark):
    at = folder(spark)
    put(spark, f"{at}/deep/w.dict.yaml", "name: w\n...\n食\tziah8\t3\n# no\n飯\tbng7\t1\nshort\tline\n")
    put(spark, f"{at}/w.schema.yaml", "...\nx\ty\t1\n")
    return readers.dictionary(spark, at, fields=3)


@case("s8_external_walk", "file_no source poj dp han", [(0, "ChhoeTaigiDatabase > b", "chúi", "", "水"), (1, "ChhoeTaigiDatabase > c", "hóe", "", "火"), (2, "ChhoeTaigiDatabase > a", "sin", "", "身"), (3, "dieghv > w.dict", "", "ziah⁸", "食")])
def _(spark):
    at = folder(spark)
    head = "PojUnicode,KipUnicode,HanLoTaibunPoj\n"
    put(spark, f"{at}/ChhoeTaigiDatabase/x/c.csv", head + "hóe,,火\n")
    put(spark, f"{at}/ChhoeTaigiDatabase/b.csv", head + "chúi,,水\n")
    put(spark, f"{at}/ChhoeTaigiDatabase/a.tsv", head.replace(",", "\t") + "sin\t\t身\n")
    put(spark, f"{at}/dieghv/w.dict.yaml", "...\n食\tziah8\n")
    put(spark, f"{at}/dieghv/w_60.dict.yaml", "...\n飯\tbng7\n")
    return external.external(spark, at)


@case("s10_small_tables", "key words", [("伊", "佢|他"), ("words", "China|God")])
def _(spark):
    at = folder(spark)
    put(spark, f"{at}/v.csv", "recommend,variant_1,variant_2,variant_3\n伊,佢,,他\n無,,,\n")
    put(spark, f"{at}/w.csv", "word\nGod\nChina\nGod\n\n")
    known = readers.variants_of(spark, f"{at}/v.csv") | {"words": readers.words_of(spark, f"{at}/w.csv")}
    return spark.createDataFrame([(k, "|".join(v)) for k, v in known.items()], "key string, words string")


@case("s12_paths", "kind name", [("all", "external/b.csv"), ("all", "clippings/a.csv"), ("all", "books/c.csv"), ("all", "merged.csv"), ("some", "clippings/a.csv"), ("some", "books/c.csv"), ("warning", "path not found")])
def _(spark):
    at = folder(spark)
    for name in ("books/c.csv", "external/b.csv", "clippings/a.csv", "clippings/no.txt", "merged.csv"):
        put(spark, f"{at}/{name}", "han\n")
    short = lambda p: p.rpartition(at.rpartition("/")[2] + "/")[2]
    every, _ = external.exported_tables(spark, at)
    some, warnings = external.exported_tables(spark, at, ["clippings/a.csv", "books", "nowhere"])
    return spark.createDataFrame([("all", short(p)) for p in every] + [("some", short(p)) for p in some] + [("warning", w.partition(":")[0]) for w in warnings], "kind string, name string")


@query(
    "WITH two AS (SELECT coalesce(lang, 'none') || '_original' AS name, " + resolved(" the ", "  ", " of ", " to ") + " AS text FROM documents UNION ALL SELECT coalesce(lang, 'none') || '_modified', " + resolved(" THE ", " and ", "  ", " 〔〕 ") + " FROM documents), "
    "line AS (SELECT name, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM two) SELECT name, md5(line) AS digest, count(*) AS n FROM line GROUP BY ALL"
)
def k1_renditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of each language as a marked book: its two renditions are written, and their lines read back."""
    at = folder(spark)
    writers.renditions(marked(spark, sf_dir).select(F.coalesce("lang", F.lit("none")).alias("file"), F.replace("text", F.lit("\r"), F.lit("")).alias("text")), at)
    return spark.read.text(at).groupBy("name", F.md5("value").alias("digest")).agg(F.count("*").alias("n"))


def csv_lines(spark: SparkSession, path: str, header: str) -> DataFrame:
    """(n, line) of a CSV folder, in the order of its part files, which begin with a header each."""
    rows = spark.read.text(path).select(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"), F.col("value").alias("line"))
    return G.numbered(rows.where(F.col("line") != header), "f", "b", "i").select(F.col("row").alias("n"), "line")


@query("SELECT row_number() OVER (ORDER BY lower(p_name), p_partkey) AS n, p_name || ',' || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_name || '?' END || ',' || p_type AS line FROM part")
def k2_book_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts as a book, every other one with another original, written in order; the lines of the files in order."""
    at = folder(spark)
    name = F.col("p_name")
    own = F.when(F.col("p_partkey") % 2 == 0, name).otherwise(F.concat(name, F.lit("?")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("line_no"), F.lit(0).alias("part_no"), name.alias("puj"), own.alias("puj_orig"), F.lit("").alias("poj"), F.col("p_type").alias("en"))
    writers.book_csv(rows, at, ["puj", "puj_orig", "en"])
    return csv_lines(spark, at, "puj,puj_orig,en")


@case("k4_merged_csv", "file latn_norm han", [("m", "a1", "啊"), ("m", "li2", "你,妳")])
def _(spark):
    at = folder(spark)
    writers.csv(spark.createDataFrame([(2, "li2", "你,妳"), (1, "a1", "啊")], "seq int, latn_norm string, han string"), at, ["latn_norm", "seq"], ["latn_norm", "han"])
    return readers.table(spark, at, ["latn_norm", "han"]).withColumn("file", F.lit("m"))


@case("k5_dictionary_file", "text code weight", [("水", "cui2", 9), ("火", "hue2", 4)])
def _(spark):
    at = folder(spark)
    writers.dictionary(spark.createDataFrame([("火", "hue2", 4), ("水", "cui2", 9)], "text string, code string, weight int"), at, "p", "note", imports=("q",))
    rows = spark.read.text(at).where(F.col("value").contains("\t")).select(F.split("value", "\t").alias("f"))
    return rows.select(F.col("f")[0].alias("text"), F.col("f")[1].alias("code"), F.col("f")[2].cast("int").alias("weight"))


@case("k8_dictionary_head", "n line", list(enumerate(["# Rime dictionary: p", "# note", "---", "name: p", 'version: "19700101.000000"', "sort: by_weight", "import_tables:", "  - q", "  - r", "...", ""])))
def _(spark):
    return spark.createDataFrame(list(enumerate(writers.header("p", "note", imports=("q", "r")))), "n int, line string")


@query(
    "WITH p AS (SELECT DISTINCT lower(c_mktsegment) || c_name[-1:] AS p FROM customer), g AS (SELECT p, unnest([{'n': 'default.custom.yaml', 'f': 'patch:', 'a': 0}, {'n': 'rime.lua', 'f': 'local tl_filter_mod = require(''tl_filter'')', 'a': 0}, "
    "{'n': p || '_dp.schema.yaml', 'f': 'schema:', 'a': 50}, {'n': p || '_dp_en.schema.yaml', 'f': 'schema:', 'a': 0}, {'n': p || '_dp_zh.schema.yaml', 'f': 'schema:', 'a': 0}, {'n': p || '_tl.schema.yaml', 'f': 'schema:', 'a': 31}, {'n': p || '_tl_en.schema.yaml', 'f': 'schema:', 'a': 0}, {'n': p || '_tl_zh.schema.yaml', 'f': 'schema:', 'a': 0}]) AS x FROM p) "
    "SELECT p || '-' || x.n AS name, x.f AS first, CAST(CASE WHEN x.a > 0 THEN 6 ELSE 0 END AS INTEGER) AS n_package, CAST(x.a AS INTEGER) AS n_algebra FROM g"
)
def k11_engine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engine's files for packages that segments and last digits of customers name: they are written, and read back."""
    at = folder(spark)
    packages = table(spark, sf_dir, "customer").select(F.concat(F.lower("c_mktsegment"), F.substring("c_name", -1, 1)).alias("package"))
    writers.texts(engine.packages_files(packages, ["TL", "DP"]).select(F.concat_ws("-", "package", "name").alias("name"), "text"), at)
    rows = spark.read.text(at, wholetext=True).select("name", F.split("value", "\n").alias("l"))
    package = F.substring_index("name", "-", 1)
    own = F.size(F.filter("l", lambda x: F.contains(x, package)))
    schema = F.col("name").rlike("_(tl|dp).schema.yaml$")
    return rows.select("name", F.col("l")[0].alias("first"), F.when(schema, own).otherwise(0).alias("n_package"), F.size(F.filter("l", lambda x: x.rlike("^ +- (xform|derive)/"))).alias("n_algebra"))


@case("p22_punctuation", "shape key_ rule", [("full", "' '", "{ commit: '　' }"), ("full", "'<'", "[ 《, 〈, «, ‹ ]"), ("full", "''''", "{ pair: [ '‘', '’' ] }"), ("full", "'$'", "[ ￥, '$', '€', '£', '¥', '¢', '¤' ]"), ("full", "'_'", "——"), ("half", "','", "，"), ("half", "'/'", "'/'"), ("half", "'['", "【"), ("half", "'$'", "'¥'"), ("count", "full", "33"), ("count", "half", "32")])
def _(spark):
    full, half = engine.punctuation(engine.FULL), engine.punctuation(engine.HALF, frozenset())
    keys = {"full": ("' '", "'<'", "''''", "'$'", "'_'"), "half": ("','", "'/'", "'['", "'$'")}
    rows = [("full", k, r) for k, r in full if k in keys["full"]] + [("half", k, r) for k, r in half if k in keys["half"]]
    return spark.createDataFrame(rows + [("count", "full", str(len(full))), ("count", "half", str(len(half)))], "shape string, key_ string, rule string")


@query(
    "WITH c AS (SELECT c_name || '-' || c_custkey AS code, lower(c_mktsegment) AS text FROM customer) SELECT 0 AS n, 'local SYLLABLE_MAP = {' AS line "
    "UNION ALL SELECT row_number() OVER (ORDER BY code, text), '    [\"' || code || '\"] = \"' || text || '\",' FROM c UNION ALL SELECT count(*) + 1, '}' FROM c"
)
def k12_lua(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as syllables of a Lua table, in order, and what their segments are as their forms."""
    customers = table(spark, sf_dir, "customer")
    return writers.lua_lines(customers.select(F.concat_ws("-", "c_name", F.col("c_custkey").cast("string")).alias("code"), F.lower("c_mktsegment").alias("text")))


@query(
    "WITH c AS (SELECT c_custkey // 5000 AS b, c_mktsegment AS s, c_custkey % 2 AS h, replace(c_name, '#', ' ') AS name, c_custkey AS k FROM customer), "
    "q AS (SELECT b, s, h, string_agg(name, chr(10) ORDER BY k) AS names FROM c GROUP BY ALL), p AS (SELECT b, s, row_number() OVER (PARTITION BY b ORDER BY s) AS part FROM (SELECT DISTINCT b, s FROM c)), "
    "t AS (SELECT b, part, 1 AS sub, s AS title, '## ' || s AS body FROM p UNION ALL SELECT b, part, 1 + row_number() OVER (PARTITION BY b, part ORDER BY h), CASE h WHEN 0 THEN 'Even' ELSE 'Odd' END, '### ' || CASE h WHEN 0 THEN 'Even' ELSE 'Odd' END || chr(10) || names FROM q JOIN p USING (b, s)), "
    "n AS (SELECT *, 'b' || b || '_' || printf('%02d_%02d_', part, sub) || title AS name FROM t) "
    "SELECT name, '---' || chr(10) || 'title: B / ' || title || chr(10) || 'p: b/' || name || chr(10) || 'date: 2000-01-01' || chr(10) || '---' || repeat(chr(10), 5) || '[↩️ 轉總目錄](/b)' || chr(10) || chr(10) || body AS text FROM n "
    "UNION ALL SELECT 'index_b' || b, string_agg(CASE WHEN sub > 1 THEN '  ' ELSE '' END || '- [' || title || '](/b/' || name || ')', chr(10) ORDER BY part, sub) FROM n GROUP BY b"
)
def k13_pages_and_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Books of 5,000 customers each, a chapter for each segment with one part for even and one for odd keys: pages and an index of each are written, and read back."""
    at = folder(spark)
    own = lambda key, c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, c))), lambda x: x[c]), "\n")
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("b"), F.floor(F.col("c_custkey") / 5000)).alias("file"), "c_mktsegment", (F.col("c_custkey") % 2).alias("half"), "c_custkey", F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"))
    halves = rows.groupBy("file", "c_mktsegment", "half").agg(own("c_custkey", "name").alias("names"))
    halves = halves.withColumn("text", F.concat(F.lit("### "), F.when(F.col("half") == 0, "Even").otherwise("Odd"), F.lit("\n"), "names"))
    parts = halves.groupBy("file", "c_mktsegment").agg(own("half", "text").alias("text")).withColumn("text", F.concat(F.lit("## "), "c_mktsegment", F.lit("\n"), "text"))
    books = parts.groupBy("file").agg(own("c_mktsegment", "text").alias("text")).withColumn("text", F.concat(F.lit("# B\n"), "text"))
    found = S.chapters(X.lines_of(books)).withColumn("name", F.concat_ws("_", "file", "name"))
    writers.texts(S.pages_of(found, "B", "b", "2000-01-01"), f"{at}/pages")
    writers.texts(S.index_of(found, "b").select(F.concat_ws("_", F.lit("index"), "file").alias("name"), "text"), f"{at}/index")
    read = lambda part: spark.read.text(f"{at}/{part}", wholetext=True).select("name", F.rtrim("value", F.lit("\n")).alias("text"))
    return read("pages").unionByName(read("index"))


def csv_files(rows: DataFrame, path: str) -> None:
    """The rows of each name (name) as one CSV file name.csv of a folder, with a header."""
    spark, out = rows.sparkSession, spark_path(rows.sparkSession, path)
    rows.repartition("name").write.partitionBy("name").csv(f"{path}-parts", header=True)
    fs = out.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(out)
    for p in external.files(spark, f"{path}-parts", "*.csv"):
        at = spark_path(spark, p)
        fs.rename(at, spark_path(spark, f"{path}/{at.getParent().getName().partition('=')[2]}.csv"))


def spark_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


@query(
    "WITH f AS (SELECT 'm' || lpad(CAST(c_custkey // 5000 AS VARCHAR), 6, '0') AS f, count(*) AS n, count(*) FILTER (c_custkey % 3 = 0) AS e, count(*) FILTER (c_custkey % 2 = 0) AS w FROM customer GROUP BY 1), "
    "a AS (SELECT * FROM f UNION ALL SELECT NULL, sum(n), sum(e), sum(w) FROM f), k AS (SELECT unnest([1, 5]) AS s), "
    "l AS (SELECT s, f, coalesce(f, 'all') || ': ' || CAST(n AS BIGINT) || ' rows, ' || CAST(e AS BIGINT) || ' errors, ' || CASE s WHEN 1 THEN CAST(w AS BIGINT) ELSE 0 END || ' warnings' AS line FROM a, k "
    "UNION ALL VALUES (0, NULL, 'WARNING: path not found'), (3, NULL, 'code 1'), (4, NULL, 'errors only'), (7, NULL, 'code 1') UNION ALL SELECT 2, NULL, 'poj:roundtrip: ' || CAST(w AS BIGINT) FROM a WHERE f IS NULL) "
    "SELECT row_number() OVER (ORDER BY s, f NULLS LAST) - 1 AS n, line FROM l"
)
def k14_v5_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as tables of 5,000 entries each, written as CSV files: the report of their check, and that of errors only."""
    at, key = folder(spark), F.col("c_custkey")
    name = F.concat(F.lit("m"), F.lpad(F.floor(key / 5000).cast("string"), 6, "0")).alias("name")
    csv_files(table(spark, sf_dir, "customer").select(name, F.when(key % 3 == 0, "a漢").otherwise("人").alias("han"), F.col("c_name").alias("en"), F.when(key % 2 == 0, "lo8").otherwise("lí").alias("poj")), f"{at}/m")
    _, code = writers.check(spark, at, ["m", "nowhere"], output=f"{at}/report")
    lines = [r["value"] for r in spark.read.text(f"{at}/report").collect()]
    lines = [line.partition(": /")[0].partition(": file:")[0] for line in lines] + [f"code {code}", "errors only"]
    text, code = writers.check(spark, at, ["m"], errors_only=True)
    return spark.createDataFrame(list(enumerate(lines + text.rstrip("\n").split("\n") + [f"code {code}"])), "n long, line string")


@query("SELECT row_number() OVER (ORDER BY c_mktsegment, c_name) AS n, c_mktsegment || ',' || lower(c_mktsegment) || ',' || c_name AS line FROM customer")
def k16_syllabary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as characters of the syllables that their segments are, written in order; the lines of the files in order."""
    at = folder(spark)
    writers.syllabary_csv(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("latn_norm"), F.lower("c_mktsegment").alias("puj"), F.col("c_name").alias("han")), at)
    return csv_lines(spark, at, "latn_norm,puj,han")


@case("t15_one_text", "system text", [("POJ", "chúi"), ("TL", "tsúi")])
def _(spark):
    from glyphmill.__main__ import convert

    return spark.createDataFrame(list(convert(spark, "chui2", "LATN_NORM", ["POJ", "TL"]).items()), "system string, text string")


@query(
    f"WITH {SQL_WORDS}, s AS (SELECT doc_id, pos, regexp_replace(lower(word), '[^a-z]', '', 'g') AS b, CASE WHEN pos % 2 = 0 THEN '4' ELSE '1' END AS t FROM word), "
    "x AS (SELECT *, CASE WHEN regexp_matches(b, '^.+nnh$') THEN b[:-4] WHEN regexp_matches(b, '^.+[ptkh]$') THEN b[:-2] ELSE b END AS left_ FROM s WHERE b <> '') "
    "SELECT doc_id * 16777216 + pos AS seq, b || t AS latn_norm FROM x WHERE NOT ((regexp_matches(b, '[aeiou]') OR regexp_matches(left_, '(m|ng|n)$')) AND (t = '1' OR regexp_matches(b, '(hnn|[ptkh])$')))"
)
def f5_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The letters of the documents' words as syllables of two tones: the rows that a merge sets aside."""
    base = words(spark, sf_dir).select(L.numbered(F.col("doc_id"), F.col("pos")).alias("seq"), F.regexp_replace(F.lower("word"), "[^a-z]", "").alias("b"), F.when(F.col("pos") % 2 == 0, "4").otherwise("1").alias("t"))
    rows = base.select("seq", F.when(F.col("b") != "", F.concat("b", "t")).otherwise("").alias("latn_norm"))
    return L.merged(rows.select("seq", *[(F.col(c) if c == "latn_norm" else F.lit("")).alias(c) for c in L.MERGED]))[1].select("seq", "latn_norm")


@case("v2_messages", "row field message", [(1, "han", "pos 1: unexpected char x"), (2, "en", "pos 0: unexpected char 漢")])
def _(spark):
    return V.findings(spark.createDataFrame([("f", 1, "人x", "a"), ("f", 2, "", "漢a")], "file string, row int, han string, en string"))
