"""Order-sensitive weights against a plain fold, whatever the partitions; files written and read back."""

import random

import pytest
from pyspark.sql import functions as F

from glyphmill.operators import lexicon as L
from glyphmill.sources import readers, writers


def fold(rows):
    weights = {}
    for _, latn, han, variants, source in rows:
        base = int(100 * (0.5 if source == "dieghv" else 1))
        weights[latn, han] = weights[latn, han] + 1 if (latn, han) in weights else base
        w = base
        for v in filter(None, variants.split("|")):
            w //= 2
            if w > 0:
                weights[latn, v] = weights[latn, v] + 1 if (latn, v) in weights else w
    return weights


@pytest.mark.parametrize("parts", [1, 7])
def test_weights_like_a_fold(spark, parts):
    rnd = random.Random(3)
    rows = [(i, f"{rnd.choice('ab')}1", rnd.choice("甲乙丙"), "|".join(rnd.choices("甲乙丙丁", k=rnd.randint(0, 9))), rnd.choice(["dieghv", "x"])) for i in range(400)]
    df = spark.createDataFrame(rows, "seq int, latn_norm string, han string, han_variants string, source string").repartition(parts)
    df = df.withColumns({c: F.lit("") for c in ("puj", "dp")}).withColumn("_latn", F.col("latn_norm"))
    got = {(r.latn_norm, r.han): r.weight for r in L.entries(df).collect()}
    assert got == fold(rows)


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.dict.yaml").write_text("# c\nname: a\n...\n\n#x\n巴\tba1\n\tno\nbad\n大\tdua7\n", "utf-8")
    (tmp_path / "in/a.schema.dict.yaml").write_text("...\nx\ty\n", "utf-8")
    got = readers.dictionary(spark, str(tmp_path / "in")).select("text", "code").collect()
    assert sorted(map(tuple, got)) == [("大", "dua7"), ("巴", "ba1")]
    (tmp_path / "t.csv").write_text('word,b\n"x, ""y""",\nz,2\n', "utf-8")
    rows = readers.table(spark, str(tmp_path / "t.csv"), ["word", "b", "c"]).select("word", "b", "c").collect()
    assert sorted(map(tuple, rows)) == [("x, \"y\"", "", ""), ("z", "2", "")]
    assert readers.words_of(spark, str(tmp_path / "t.csv")) == ['x, "y"', "z"]
    (tmp_path / "m").mkdir()
    (tmp_path / "m/README.md").write_text("no")
    (tmp_path / "m/b.md").write_text("# T\nx")
    assert [tuple(r) for r in readers.markdown(spark, str(tmp_path / "m")).collect()] == [("b", "# T\nx")]
    df = spark.createDataFrame([("乙", "b1", 5), ("甲", "a1", 9)], "text string, code string, weight int")
    writers.dictionary(df, str(tmp_path / "out"), "d", "note")
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text("utf-8").splitlines()]
    assert lines[:2] == ["# Rime dictionary: d", "# note"] and lines[-2:] == ["乙\tb1\t5", "甲\ta1\t9"]
    back = readers.dictionary(spark, str(tmp_path / "out"), fields=3)
    assert back.where("text = '甲'").count() <= 1
    writers.csv(df, str(tmp_path / "csv"), ["code"], ["text", "code"])
    assert "derive/nn//" in writers.schema_text("TL", "p") and '["a1"] = "甲"' in writers.lua_table(df)
    from glyphmill.operators import extract as X

    book = X.handbook(X.lines_of(spark.createDataFrame([("b", "- **One** tsek ... ... ... 一")], "file string, text string")))
    writers.book_csv(book, str(tmp_path / "book"), X.ENTRY)
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "book").glob("part-*.csv"))
    assert text.splitlines()[1].startswith("tsek,,")
    chapters = spark.createDataFrame([("n", "t")], "name string, text string")
    writers.texts(chapters, str(tmp_path / "texts"))


def test_import_works_without_the_corpus_operators():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "a2_word_weights" in e.queries()
