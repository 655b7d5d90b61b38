"""Every query with SQL against that SQL, on a small table and on one of odd rows."""

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from glyphmill.llm.queries import oracle_sql, queries

TABLES = "documents", "pages", "benchmark", "labels", "embeddings"
SF = "/root/testdata/sf0.001"


def odd_tables(folder):
    passage = " ".join(f"Word{i}" for i in range(30))
    texts = [
        "", " \n\t ", "one", "a b c", passage, passage + "\n" + passage, "x " * 200, "line one\nline two\nline three\nline four", "line one\nline two\nline three\nline four",
        "zz\nline two\nline three\nline four\n\nline two\nline three\nline four\nend", "Ünï cödé 漢字 " * 30, "word4 word5 WORD6 word7-word8,word9 word10 word11 word12 word13 tail", "same same same\n" * 40,
        "&&& ### $$$ " * 60, passage.lower(), None, "tick' s it's", "a b c　d " * 20, "line two\r\nline three\r\nline four", "very long " + " ".join(f"w{i % 977}" for i in range(20000)),
    ]
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "lang": "en", "source": [["b", "a", None, "Ä"][i % 4] for i in range(len(texts))], "n_chars": [len(t or "") for t in texts]})
    docs["n_words"], docs["key"] = 7, "clash"
    bench = pd.DataFrame({"item_id": range(5), "text": [passage, "Same same SAME", "", None, "a b c d e f g h i j k l"]})
    rnd = np.random.default_rng(5)
    own = rnd.normal(size=(30, 64)).tolist()
    vectors = [*own, *(np.array(own[:12]) + rnd.normal(size=(12, 64)) * 0.2).tolist(), *own[:3], None, [], [0.0] * 64, [1.0] * 63 + [None], [float("nan")] * 64, [float("inf")] + [1.0] * 63]
    ids = [*range(40), None, None, *range(42, len(vectors))]
    odd = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([None] * len(ids), pa.int32()), "n_links": pa.array(ids, pa.int64())})
    pq.write_table(odd, folder / "embeddings.parquet")
    for name, df in (("documents", docs), ("benchmark", bench)):
        df.to_parquet(folder / f"{name}.parquet")
    return str(folder)


def plain(x):
    """A cell as a Python value: a whole number is an int, whatever type pandas gave a column with nulls."""
    if pd.isna(x):
        return None
    x = x.item() if hasattr(x, "item") else x
    return int(x) if isinstance(x, float) and x.is_integer() else x


def rows_of(df):
    return sorted([tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)], key=repr)


def compare(spark, name, folder):
    con = duckdb.connect()
    for t in TABLES:
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
        except duckdb.IOException:
            pass
    want = con.execute(oracle_sql()[name]).df()
    got = queries()[name](spark, folder).toPandas()
    assert sorted(want.columns) == sorted(got.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_small_table(spark, name):
    compare(spark, name, SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_odd_rows(spark, name, tmp_path):
    compare(spark, name, odd_tables(tmp_path))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_empty(spark, name, tmp_path):
    for t in TABLES:
        pq.write_table(pq.read_table(f"{SF}/{t}.parquet").slice(0, 0), tmp_path / f"{t}.parquet")
    assert queries()[name](spark, str(tmp_path)).collect() == []
