"""The runs and codes that are parted: their letters are found in whole texts, not by a pattern for each word."""

from glyphmill.plans import lookups

TEXTS = ["Ab -- c'D, e\nf", "x", "", None, "12 34", "a\u000bb\tÄc d\r\n\r\n", "a" * 20 + " bcde f " + "g" * 24, "KK iİ  o o"]


def runs_of(texts):
    out = set()
    for t in texts:
        parts = (t or "").lower().replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\v", " ").split(" ")
        w = [x for x in ("".join(c for c in p if "a" <= c <= "z") for p in parts) if x]
        out |= {a + b for a, b in zip(w[::2], w[1::2]) if len(a + b) <= 24}
    return out


def test_runs_and_codes(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.typed for r in lookups._runs(spark, str(tmp_path)).collect()} == runs_of(TEXTS)
    codes = {r.code: r.weight for r in lookups._codes(spark, str(tmp_path)).collect()}
    assert codes == {"ab": 1, "cd": 1, "bcde": 1, "a" * 20: 1, "g" * 24: 1, "kk": 1, "ii": 1}


def test_texts_are_read_by_no_pattern_of_rows(spark):
    """Each text is gone through once for all its words: no row for each word before they are put together."""
    plan = str(lookups._codes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan())
    assert "MapInArrow" in plan and "regexp" not in plan and "Generate" not in plan
