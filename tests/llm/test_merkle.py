"""The manifest against a plain tree, with odd rows, and what proofs say when rows change."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from glyphmill.llm.merkle import leaf_hash, merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, part int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [None if x is None else str(x) for x in (row[0], row[3], row[2], row[4], text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(leaves):
    """The root, and the siblings (before, after) of each leaf, level by level."""
    paths = [[] for _ in leaves]
    own = [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        up, below = [], []
        for at in range(0, len(leaves), 3):
            run = leaves[at : at + 3]
            for j in range(len(run)):
                for i in own[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h("".join(run)))
            below.append([i for x in own[at : at + 3] for i in x])
        leaves, own = up, below
    return leaves[0], paths


def plain(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    subs = {}
    for source, own in by_source.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        subs[source] = tree([leaf(r, r[1]) for r in own])
    order = sorted(subs, key=lambda s: (s is not None, (s or "").encode()))
    root, over = tree([subs[s][0] for s in order])
    out = []
    for s, path in zip(order, over, strict=True):
        for r, own in zip(by_source[s], subs[s][1], strict=True):
            path_ = own + path
            found = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and found is not None:
                found = found.replace("\n", "")
            fold = leaf(r, found)
            for before, after in path_:
                fold = h(before + fold + after)
            out.append((r[0], leaf(r, r[1]), subs[s][0], root, h("".join(a + b for a, b in path_)), fold, fold == root))
    return out


def made(n, sources, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = rnd.choice(["", None, "a\nb", "ü漢\n", "plain", "long words " * rnd.choice([1, 500])])
        rows.append((rnd.choice([i, i, i, 7, None]), text, rnd.choice(["en", None, ""]), rnd.choice(sources), rnd.choice([3, None, -1]), "clash", 1))
    return rows + rows[:3] * 2


def compared(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = merkle_manifest(df, F.replace("text", F.lit("\n"), F.lit("")), F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(rows)))


@pytest.mark.parametrize("n", [1, 5, 240, 800])
def test_like_a_plain_tree(spark, n):
    compared(spark, made(n, [None, "", "-", "a", "ä", "b"] + ["hot"] * 9, n))


def test_many_sources_and_one(spark):
    compared(spark, made(300, [f"s{i}" for i in range(280)]))
    compared(spark, made(4, ["one"]))
    compared(spark, [(1, "x", "en", None, 1, "", 0)])


def test_equal_rows_by_the_hundred(spark):
    compared(spark, [(5, "same\n", "en", "a", 5, "", 0)] * 700)


def test_empty_table_and_rows_that_nobody_touched(spark):
    assert merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    out = merkle_manifest(spark.createDataFrame(made(50, ["a", None]), SCHEMA)).collect()
    assert out and all(r.verified and r.folded_root == r.root for r in out)


def test_leaf_of_nulls(spark):
    df = spark.createDataFrame([(None, "ä")], "a long, b string")
    assert df.select(leaf_hash(F.col("a"), F.col("b")).alias("h")).first().h == h("-2:ä")
