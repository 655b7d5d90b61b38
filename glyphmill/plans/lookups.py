"""Queries over whole tables that answer what is typed: spelling rules, prefix index, segmentation, tables of variants. Each has SQL
that says the same in another way; that of the rules is made from the same rule lists, which are data."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphmill.operators import lookup as R
from glyphmill.operators import ranges as G
from glyphmill.operators import segment as S
from glyphmill.operators import spelling as P
from glyphmill.operators import variants as V
from glyphmill.plans.corpus import SQL_WORDS, query, table, words

SYSTEMS = "POJ TL PUJ BP DP".split()


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, code, weight): the words of the documents in small letters, their runs of letters as syllables of the first tone, and their number."""
    rows = words(spark, sf_dir).groupBy(F.lower("word").alias("text")).agg(F.count("*").cast("int").alias("weight"))
    code = F.array_join(F.transform(F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0)), lambda s: F.concat(s, F.lit("1"))), "  ")
    return rows.select("text", code.alias("code"), "weight").where("code <> ''")


SQL_DICTIONARY = SQL_WORDS + r", dict AS (SELECT text, array_to_string(list_transform(regexp_extract_all(text, '[a-z]+'), lambda s: s || '1'), '  ') AS code, weight FROM (SELECT lower(word) AS text, CAST(count(*) AS INTEGER) AS weight FROM word GROUP BY ALL) WHERE regexp_matches(text, '[a-z]'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule_steps(system: str) -> list[str]:
    """A table for each rule; the last is sp_<system>(syl, x). A look ahead at the end of a pattern takes the letter and puts it back."""
    steps = [f"sp_{system}_0 AS (SELECT DISTINCT unnest(string_split(code, '  ')) AS syl, syl AS x FROM dict)"]
    rules = R.algebra(system)[:-26]
    for i, rule in enumerate(rules):
        verb, old, new = re.fullmatch("([a-z]+)/(.*)/(.*)/", rule).groups()
        new = re.sub(r"\$(\d)", r"\\\1", new)
        if m := re.fullmatch(r"(.*)\(\?=(.*)\)", old):
            old, new = f"{m[1]}({m[2]})", new + r"\1"
        changed = f"regexp_replace(x, {_quoted(old)}, {_quoted(new)}, 'g')"
        kept = f"SELECT syl, x FROM sp_{system}_{i} UNION " if verb == "derive" else ""
        name = f"sp_{system}" if i == len(rules) - 1 else f"sp_{system}_{i + 1}"
        steps.append(f"{name} AS MATERIALIZED ({kept}SELECT syl, {changed} AS x FROM sp_{system}_{i})")
    return steps


def _prefix_sql() -> str:
    steps, every = [], []
    for s in SYSTEMS:
        steps += _rule_steps(s)
        steps.append(f"h_{s} AS (SELECT lead, 1 AS i, x[:5] AS parts, least(length(x), 5) AS n FROM lead JOIN sp_{s} ON syl = lead[1] WHERE x <> '' UNION SELECT lead, i + 1, parts || ' ' || x[:5 - n], n + least(length(x), 5 - n) FROM h_{s} JOIN sp_{s} ON syl = lead[i + 1] WHERE n < 5 AND i < len(lead) AND x <> '')")
        steps.append(f"p_{s} AS (SELECT DISTINCT lead, array_to_string(string_split(parts, ' '), '')[:k] AS prefix FROM h_{s}, range(1, 6) AS t(k) WHERE k <= n)")
        every.append(f"SELECT '{s}' AS system, prefix, text, code, weight, row_number() OVER (PARTITION BY prefix ORDER BY weight DESC, text, code) AS place FROM p_{s} JOIN dict ON string_split(code, '  ')[:5] = lead")
    head = f"WITH RECURSIVE {SQL_DICTIONARY}, lead AS (SELECT DISTINCT string_split(code, '  ')[:5] AS lead FROM dict)"
    return ",\n".join([head, *steps]) + f"\nSELECT system, prefix, CAST(place AS INTEGER) AS place, text, code, weight FROM ({' UNION ALL '.join(every)}) WHERE place <= 6"


@query(_prefix_sql())
def r4_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six heaviest entries for every prefix up to five letters, by the whole rule list of each system."""
    known = dictionary(spark, sf_dir)
    found = [P.best_of_prefix(P.prefix_index(known, R.algebra(s), letters=5, most=6), most=6).select(F.lit(s).alias("system"), "*") for s in SYSTEMS]
    return reduce(DataFrame.unionByName, found)


def _spelling_sql() -> str:
    steps = [x for s in SYSTEMS for x in _rule_steps(s)]
    every = [f"SELECT '{s}' AS system, syl AS syllable, count(*) AS n, md5(string_agg(x, ',' ORDER BY x)) AS digest FROM (SELECT DISTINCT syl, x FROM sp_{s} WHERE x <> '') GROUP BY syl" for s in SYSTEMS]
    return f"WITH {SQL_DICTIONARY},\n" + ",\n".join(steps) + "\n" + " UNION ALL ".join(every)


@query(_spelling_sql())
def r3_r8_syllables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ways to spell every syllable, by the whole rule list of each system but for capitals."""
    known = dictionary(spark, sf_dir).select(F.explode(P.syllables(F.col("code"))).alias("code")).distinct()
    found = []
    for s in SYSTEMS:
        ways = P.respelled(known, P.without_case(R.algebra(s))[0]).groupBy("code").agg(F.count("*").alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list("spelling")), ",")).alias("digest"))
        found.append(ways.select(F.lit(s).alias("system"), F.col("code").alias("syllable"), "n", "digest"))
    return reduce(DataFrame.unionByName, found)


LONGEST = 12


def _small_letters(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """The small letters of each word that has any, of all texts of a batch, and the row of each. What is neither a letter nor white space goes from whole texts
    at once."""
    texts = pc.replace_substring_regex(batch.column(0), "[^a-z\x20\x09-\x0D]+", "")
    each = pc.split_pattern_regex(texts, "[\x20\x09-\x0D]+")
    row, word = pc.list_parent_indices(each), pc.list_flatten(each)
    full = pc.not_equal(word, "")
    return word.filter(full), row.filter(full).to_numpy()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, row = _small_letters(batch)
        first = np.searchsorted(row, row)
        at = np.flatnonzero((np.arange(len(row)) - first) % 2 == 0)
        at = at[at + 1 < len(row)]
        at = at[row[at] == row[at + 1]]
        typed = pc.binary_join_element_wise(word.take(pa.array(at)), word.take(pa.array(at + 1)), "")
        yield pa.RecordBatch.from_arrays([pc.unique(typed.filter(pc.less_equal(pc.binary_length(typed), 24)))], ["typed"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pc.value_counts(_small_letters(batch)[0])
        yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["code", "n"])


def _lower_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.lower(F.coalesce("text", F.lit(""))).alias("text"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(typed): each two neighbouring words of a document that have letters, their small letters run together, 24 at most."""
    return _lower_texts(spark, sf_dir).mapInArrow(_pairs, "typed string").distinct()


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, weight): the letters of the documents' words of two letters and more, and how often they are there."""
    return _lower_texts(spark, sf_dir).mapInArrow(_word_counts, "code string, n long").where("length(code) > 1").groupBy("code").agg(F.sum("n").alias("weight"))


_SQL_RUNS = rf"""
l AS (SELECT list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'), lambda w: regexp_replace(lower(w), '[^a-z]+', '', 'g')), lambda w: w <> '') AS w FROM documents),
run AS (SELECT DISTINCT w[i] || w[i + 1] AS typed FROM l, unnest(range(1, len(w), 2)) AS t(i) WHERE length(w[i] || w[i + 1]) <= 24),
code AS (SELECT code, count(*) AS weight FROM (SELECT unnest(w) AS code FROM l) WHERE length(code) > 1 AND length(code) <= {LONGEST} GROUP BY code),
part AS (SELECT typed, i - 1 AS start, k AS length, typed[i:i + k - 1] AS code FROM run, unnest(range(1, length(typed) + 1)) AS t(i), unnest(range(1, {LONGEST + 1})) AS u(k) WHERE i + k - 1 <= length(typed)),
span AS MATERIALIZED (SELECT typed, start, length, weight FROM part JOIN code USING (code))"""


@query(f"WITH {_SQL_RUNS} SELECT typed, CAST(start AS INTEGER) AS start, CAST(length AS INTEGER) AS length, weight FROM span WHERE start = 0")
def j6_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes that begin each run, and the letters that they take."""
    return S.beginnings(_runs(spark, sf_dir), _codes(spark, sf_dir), LONGEST)


@query(
    f"""WITH RECURSIVE {_SQL_RUNS},
step AS MATERIALIZED (SELECT typed, start, start + length AS stop, length, 0 AS unknown, weight FROM span UNION ALL SELECT typed, i - 1, i, 1, 1, 0 FROM run, unnest(range(1, length(typed) + 1)) AS t(i)),
way AS (SELECT typed, 0 AS reached, [{{'u': 0::BIGINT, 'k': 0::BIGINT, 'w': 0::BIGINT, 'l': []::BIGINT[]}}] AS best FROM run
  UNION ALL
  SELECT way.typed, reached + 1, list_append(any_value(best), min({{'u': best[start + 1].u + unknown, 'k': best[start + 1].k + 1, 'w': best[start + 1].w - weight, 'l': list_append(best[start + 1].l, length)}}))
  FROM way JOIN step ON step.typed = way.typed AND step.stop = way.reached + 1 GROUP BY way.typed, reached),
last AS (SELECT typed, best[len(best)] AS b FROM way WHERE reached = length(typed))
SELECT typed, array_to_string(list_transform(range(1, len(b.l) + 1), lambda i: substr(typed, CAST(coalesce(list_sum(b.l[1:i - 1]), 0) AS BIGINT) + 1, b.l[i])), ' ') AS pieces, CAST(b.u AS INTEGER) AS unknown, CAST(b.k AS INTEGER) AS words, -b.w AS weight FROM last"""
)
def r5_segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run parted into codes."""
    found = S.segmented(_runs(spark, sf_dir), _codes(spark, sf_dir), LONGEST)
    return found.select("typed", F.array_join("pieces", " ").alias("pieces"), "unknown", "words", "weight")


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key): all runs of three to twelve small letters in the documents, each once, and what is left of them without the first letter."""
    runs = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    one = table(spark, sf_dir, "documents").select(F.explode(runs).alias("key")).where("length(key) between 3 and 12").distinct()
    return one.unionByName(one.where("length(key) > 5").select(F.substring("key", 2, 12).alias("key"))).distinct()


_SQL_KEYS = "one AS (SELECT DISTINCT key FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS key FROM documents) WHERE length(key) BETWEEN 3 AND 12), key AS (SELECT key FROM one UNION SELECT key[2:] FROM one WHERE length(key) > 5)"


@query(
    f"""WITH {_SQL_KEYS}, d AS (SELECT doc_id, lower(coalesce(text, '')) AS text FROM documents),
c AS (SELECT doc_id, b + j AS start, p[j + 1:j + 12] AS win FROM (SELECT doc_id, b * 200 AS b, text[b * 200 + 1:b * 200 + 211] AS p, length(text) AS n FROM d, unnest(range(0, (length(text) + 199) // 200)) AS t(b)), unnest(range(0, 200)) AS u(j) WHERE b + j < n),
m AS (SELECT doc_id, start, max(k) AS n FROM c, unnest(range(3, 13)) AS u(k) SEMI JOIN key ON key.key = win[1:k] WHERE k <= length(win) GROUP BY doc_id, start),
l AS (SELECT doc_id, list({{'s': start, 'n': n, 'stop': 0::BIGINT, 'kept': []::VARCHAR[]}} ORDER BY start) AS l FROM m GROUP BY doc_id),
f AS (SELECT doc_id, list_reduce(list_prepend({{'s': 0::BIGINT, 'n': 0::BIGINT, 'stop': 0::BIGINT, 'kept': []::VARCHAR[]}}, l), lambda a, x: CASE WHEN x.s >= a.stop THEN {{'s': 0::BIGINT, 'n': 0::BIGINT, 'stop': x.s + x.n, 'kept': list_append(a.kept, x.s || ':' || x.n)}} ELSE a END).kept AS kept FROM l)
SELECT doc_id, len(kept) AS n, md5(array_to_string(kept, ',')) AS digest FROM f"""
)
def j2_known_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of all keys stand in each document's whole text, from the left, the longest first."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    found = V.known(texts, _keys(spark, sf_dir))
    said = F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["length"].cast("string")))
    return found.select(F.col("id").alias("doc_id"), F.size("spans").cast("long").alias("n"), F.md5(F.array_join(said, ",")).alias("digest"))


@query(
    """WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS key FROM part), t AS (SELECT key, list_sort(list_distinct([upper(key), reverse(key)])) AS v FROM w WHERE key <> ''),
v AS (SELECT key, list_filter(v, lambda x: x <> '') AS v FROM t),
p AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS k FROM part),
a AS (SELECT p_partkey, p_name, list_prepend(k[1], v.v) AS a, k FROM p JOIN v ON v.key = k[1]),
b AS (SELECT p_partkey, p_name, a, CASE WHEN len(k) < 2 OR k[2] = k[1] THEN [NULL] ELSE list_prepend(k[2], v.v) END AS b, k FROM a LEFT JOIN v ON v.key = k[2]),
c AS (SELECT p_partkey, p_name, x, y, k FROM b, unnest(a) AS s(x), unnest(b) AS t(y)),
o AS (SELECT p_partkey, p_name, CASE WHEN len(k) < 2 THEN x ELSE x || ' ' || coalesce(y, x) END AS spelled FROM c)
SELECT p_partkey, spelled FROM o WHERE spelled <> p_name"""
)
def j1_compiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spellings of the names of parts, by a table of their words in capitals and reversed."""
    part = table(spark, sf_dir, "part")
    keys = part.select(F.explode(F.split("p_name", " ", -1)).alias("key")).where("key <> ''").distinct()
    variants = keys.select("key", F.array(F.upper("key"), F.reverse("key")).alias("variants"))
    found = V.compiled(part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text")), variants)
    return found.select(F.col("id").alias("p_partkey"), F.explode("spelled").alias("spelled"))


@query(f"WITH {SQL_WORDS}, n AS (SELECT doc_id, row_number() OVER (ORDER BY word, doc_id, pos) AS row FROM word) SELECT doc_id, count(*) AS n, min(row) AS first, max(row) AS last, CAST(sum(row) AS BIGINT) AS total FROM n GROUP BY doc_id")
def o1_w3_numbered_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word numbered in the order of all words."""
    rows = G.numbered(words(spark, sf_dir).select("word", "doc_id", "pos"), "word", "doc_id", "pos")
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("row").alias("first"), F.max("row").alias("last"), F.sum("row").alias("total"))


@query(
    "WITH line AS (SELECT doc_id, i - 1 AS line_no, l[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) AS t(i)), "
    "m AS (SELECT *, doc_id * 16777216 + line_no AS place, CASE WHEN starts_with(line, 'T') THEN line END AS head, CASE WHEN starts_with(line, 'Q') THEN line END AS rare FROM line) "
    "SELECT place, md5(last_value(head IGNORE NULLS) OVER w) AS head, md5(last_value(rare IGNORE NULLS) OVER w) AS rare FROM m WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
def w1_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents as one file: for each the last line before it that begins with a letter, a frequent and a rare one."""
    one = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line"))
    one = one.select(F.lit("all").alias("file"), (F.col("doc_id") * (1 << 24) + F.col("line_no")).alias("place"), "line")
    begins = lambda c: F.when(F.col("line").startswith(c), F.col("line"))
    return G.filled_down(one, "file", "place", head=begins("T"), rare=begins("Q")).select("place", F.md5("head").alias("head"), F.md5("rare").alias("rare"))
