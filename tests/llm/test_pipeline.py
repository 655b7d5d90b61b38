"""Each stage of the pipeline against a plain version, on a small table; cases for what SQL doesn't cover."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from glyphmill.llm import decontaminate as D
from glyphmill.llm.mixing import mixed, repeated
from glyphmill.llm.quality_model import Settings, held_out, quality_scores
from glyphmill.llm.quality_rules import Rules, judged, keep_good

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text, k):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, SF).cache()
    assert kept.columns == columns
    verdict = {r.row.doc_id: r.kept for r in judged(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdict.items() if k}

    rows = sorted(kept.collect())
    near = stages["near duplicates"](spark, kept, SF).cache()
    sets, parent = [sets_of(r.text, 5) for r in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert sorted(r.doc_id for r in near.collect()) == [rows[i].doc_id for i in range(len(rows)) if find(i) == i]
    assert near.columns == columns

    clean = stages["decontamination"](spark, near, SF).cache()
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.translate(FOLD))
    grams = {tuple(w[j : j + 10]) for t in bench for w in [words(t)] for j in range(max(1, len(w) - 9))}
    leaks = lambda t: any(tuple(w[j : j + 10]) in grams for w in [words(t)] for j in range(len(w) - 9))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in near.collect() if not leaks(r.text))

    mix = stages["source mix"](spark, clean, SF).cache()
    times = {r.row.doc_id: r.times for r in mixed(clean).collect()}
    assert Counter(r.doc_id for r in mix.collect()) == Counter({i: n for i, n in times.items() if n})
    assert mix.columns == columns

    out = stages["token files"](spark, mix, SF).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count = {r.doc_id: len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in mix.collect()}
    assert Counter((r.doc_id, r.n_tokens) for r in out) == Counter((r.doc_id, count[r.doc_id]) for r in mix.collect())
    assert sorted(r.start for r in out) == sorted(np.cumsum([0, *[r.n_tokens for r in sorted(out, key=lambda r: r.start)]])[:-1].tolist())


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, kept int"
    rows = [(1, None, None, None, None, "x", 1), (None, "a b c", None, "s", 3, None, 2), (2, "", "en", "s", 0, "y", 3), (2, "", "en", "s", 0, "y", 3), (3, " ".join(f"w{i}" for i in range(80)), "en", None, 9, "z", 4), (3, " ".join(f"w{i}" for i in range(80)), "en", None, 9, "z", 4)]
    for some in (rows, []):
        df = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns
            out.collect()
    assert keep_good(spark.createDataFrame(rows, schema)).count() == 2
    assert repeated(spark.createDataFrame(rows, schema)).where("doc_id is null").count() <= 3


def test_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "x x x x"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(200)] + [(1000 + i, bad if i % 20 else good, "spam") for i in range(200)] + [(5000, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for rules in (Rules(), Rules(broadcast_hosts=0, salts=3)):
        kept = {r.row.doc_id for r in judged(df, rules).where("kept").collect()}
        assert kept == {i for i, t, s in rows if s != "spam" and t == good}


def test_mix_near_targets(spark):
    rows = [(i, "w " * (1 + i % 9), "a") for i in range(3000)] + [(4000 + i, "w " * 5, "b") for i in range(50)] + [(9000 + i, "v " * 7, None) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for in_range, few in ((16, 10), (4096, 10), (64, 0)):
        out = mixed(df, in_range=in_range, broadcast_sources=few, keep=["doc_id", "source"]).collect()
        taken, target = Counter(), {}
        for r in out:
            taken[r.row.source] += r.taken
            target[r.row.source] = r.target
            assert r.taken <= 3 * r.size
        assert abs(sum(target.values()) - sum(r.size for r in out)) < 1e-6
        assert all(abs(taken[s] - target[s]) <= 5 for s in target) and target["b"] == 750


def test_leaks_in_blocks_and_near(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = docs.unionByName(docs.limit(3))
    whole = sorted(map(tuple, D.find_leaks(docs, bench).collect()))
    assert whole == sorted(map(tuple, D.find_leaks(docs, bench, most_bytes=4000).collect())) and any(r[5] for r in whole)
    df = spark.createDataFrame([(1, "x a b q c d y"), (2, "d c b a"), (3, "a b c"), (4, "a b c d")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert {r.doc_id for r in D.find_leaks(df, item, window=4).collect() if r.contaminated} == {4}
    assert {r.doc_id for r in D.find_leaks(df, item, window=4, slop=1).collect() if r.contaminated} == {1, 2, 4}


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_scores(docs.unionByName(spark.createDataFrame([(-1, None, None, None, 0), (-2, "", "", "", 0), (None, "x", "", "", 0)], docs.schema)), labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97
    assert got.count() == 1003 and got.where("score is null or score < 0 or score > 1").count() == 0
    none = quality_scores(docs.limit(3), labels.limit(0), Settings(buckets=64))
    assert [r.score for r in none.collect()] == [0.5] * 3
    assert quality_scores(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("doc_id", [0, 7, 12])
def test_held_out_is_crc32(spark, doc_id):
    import zlib

    want = zlib.crc32(str(doc_id).encode()) % 5 == 0
    assert spark.range(1).select(held_out(F.lit(doc_id)).alias("h")).first().h == want
