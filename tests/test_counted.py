"""Words are counted before anything is made of them: rows that stand for several, and plans that don't work on every place of a word."""

import pytest

from glyphmill.operators import lexicon as L
from glyphmill.plans import corpus, forms

SF = "/root/testdata/sf0.001"
ROW = "seq long, _latn string, puj string, dp string, han string, han_variants string, source string"
WORDS = [(8, "a1 b1", "", "", "xy", "yx|zz", "dieghv"), (3, "a1 b1", "", "", "xy", "yx|zz", "x"), (5, "a1 b1", "", "", "xy", "yx|zz", "x"), (1, "a1 b1", "", "", "yx", "", "x"), (9, "a1 b1", "", "", "yx", "", "x")]


def together(df):
    return df.groupBy(*[c for c in df.columns if c != "seq"]).agg({"seq": "min", "*": "count"}).withColumnRenamed("min(seq)", "seq").withColumnRenamed("count(1)", "n")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_entries_of_counted_rows(spark):
    rows = spark.createDataFrame(WORDS, ROW)
    each, counted = L.entries(rows), L.entries(together(rows))
    assert rows_of(each) == rows_of(counted)
    assert {(r.han, r.weight, r.own) for r in counted.collect()} == {("xy", 102, 24), ("yx", 104, 8), ("zz", 27, None)}


def test_char_weights_of_counted_rows(spark):
    rows = spark.createDataFrame(WORDS, ROW)
    each, counted = (L.first_and_more(L.char_events(x), ["syllable", "char"]) for x in (rows, together(rows)))
    assert rows_of(each) == rows_of(counted)


def before_sums(df) -> str:
    """The part of the plan below its first sums."""
    return str(df._jdf.queryExecution().optimizedPlan()).rsplit("Aggregate [", 1)[1]


@pytest.mark.parametrize("make", [corpus.a2_a3_a5_entries, forms.a4_char_weights])
def test_made_of_distinct_words(spark, make):
    below = before_sums(make(spark, SF))
    assert "regexp_extract_all" in below and "regexp_replace" not in below and "concat" not in below
