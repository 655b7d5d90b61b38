"""Codes at the beginnings of runs, without a row for each length that a run might begin with."""

import pytest

from glyphmill.operators import segment as S

TYPED = ["abc", "ab", "abcabc", "zab", "", None, "bca", "äbc", "abc"]
CODES = [("ab", 5), ("abc", 2), ("abcabc", 9), ("bc", None), ("abcabcd", 1), ("ä", 4), ("a", 1), ("", 3), ("ab", 7), (None, 1)]


@pytest.mark.parametrize("few", [0, 2, 200_000])
def test_beginnings_are_spans_at_the_start(spark, monkeypatch, few):
    monkeypatch.setattr(S, "FEW", few)
    typed, codes = spark.createDataFrame([(t,) for t in TYPED], "typed string"), spark.createDataFrame(CODES, "code string, weight long")
    got = S.beginnings(typed, codes, 6)
    want = S.spans(typed, codes.fillna(0), 6).where("start = 0")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert ("abcabc", 0, 6, 9) in set(map(tuple, got.collect())) and ("äbc", 0, 1, 4) in set(map(tuple, got.collect()))


def test_no_beginnings(spark):
    none = spark.createDataFrame([], "code string, weight long")
    typed = spark.createDataFrame([("ab",)], "typed string")
    assert S.beginnings(typed, none, 6).collect() == []
    assert S.beginnings(typed.where("false"), spark.createDataFrame(CODES, "code string, weight long"), 6).collect() == []
