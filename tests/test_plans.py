"""Every registered query of the lexicon against its SQL."""

import duckdb
import pandas as pd
import pytest
from pyspark.errors import AnalysisException

from glyphmill.plans import corpus, files, fixtures, forms, lookups

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
assert corpus and files and forms and lookups


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    """A cell as a Python value: a whole number is an int, whatever type pandas gave a column with nulls."""
    if pd.isna(x):
        return None
    x = x.item() if hasattr(x, "item") else x
    return int(x) if isinstance(x, float) and x.is_integer() else x


def rows_of(df):
    return sorted([tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)], key=repr)


@pytest.mark.parametrize("name", list(fixtures.QUERIES))
def test_query(spark, duck, name):
    got, want = fixtures.QUERIES[name](spark, SF).toPandas(), duck.execute(fixtures.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", ["k11_engine_files", "k12_a9_syllable_map", "k12_lua", "k13_pages_and_index", "k14_v5_check"])
def test_reads_a_table(spark, name):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        fixtures.QUERIES[name](spark, "/nowhere")
