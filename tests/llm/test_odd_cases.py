"""Odd input of single operators, and the classifier against a plain one."""

import math

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from glyphmill.llm.decontaminate import find_leaks
from glyphmill.llm.line_dedup import line_dedup
from glyphmill.llm.mixing import mixed
from glyphmill.llm.quality_model import Learner, Settings, features, quality_scores

SETTINGS = Settings(buckets=512, epochs=2)


def test_classifier_like_a_plain_one():
    rows = [("the house of the man", 1), ("buy buy now !!!", 0), ("a tree and a hill", 1), ("$$$ now now", 0), ("", 1), ("one", 0)] * 3
    at, first = features(pa.array([t for t, _ in rows]), SETTINGS.buckets)
    examples = []
    for i, (_, label) in enumerate(rows):
        own = at[first[i] : first[i + 1]].tolist()
        x = {k: SETTINGS.scale * own.count(k) / max(1, len(own)) for k in set(own)}
        examples.append((x, label))
    learner, z, n = Learner(SETTINGS), {}, {}
    bias = SETTINGS.buckets

    def weight(k):
        l1 = 0 if k == bias else SETTINGS.l1
        v = z.get(k, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((SETTINGS.beta + math.sqrt(n.get(k, 0.0))) / SETTINGS.alpha + SETTINGS.l2)

    for x, label in examples:
        keys = sorted(x)
        learner.learn(np.array([*keys, bias]), np.array([*[x[k] for k in keys], 1.0]), label)
        x = x | {bias: 1.0}
        w = {k: weight(k) for k in x}
        p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
        for k, v in x.items():
            g = (p - label) * v
            z[k] = z.get(k, 0.0) + g - (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / SETTINGS.alpha * w[k]
            n[k] = n.get(k, 0.0) + g * g
    got = learner.weights(slice(None))
    assert max(abs(got[k] - weight(k)) for k in range(bias + 1)) < 1e-9


def test_scores_are_dot_products(spark):
    rows = [(1, "the house of the man", "x"), (1, "the house of the man", "x"), (2, None, "y"), (3, "", "z"), (None, "one", "q"), (4, "word " * 200_000, "long"), (5, "buy now", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string").withColumnsRenamed({"quality": "score"})
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, None), (4, 0), (None, 1)], "doc_id long, quality int")
    out = quality_scores(docs, labels, SETTINGS).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert len({r.score for r in out if r.doc_id == 1}) == 1 and len({r.score for r in out if r.doc_id in (2, 3)}) == 1
    assert quality_scores(docs, labels, SETTINGS).orderBy("doc_id", "score").collect() == sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.score))


def test_lines_of_repeated_rows_and_null_ids(spark):
    text = "a one\nb two\nc three\nd four"
    df = spark.createDataFrame([(1, text, 1), (1, text, 1), (2, "x\n" + text, 2), (None, text, 3), (3, None, 4), (4, "", 5)], "doc_id long, text string, n_lines int")
    got = sorted((r.row.doc_id if r.row.doc_id is not None else 99, r.n_lines, r.n_removed, r.kept) for r in line_dedup(df).collect())
    assert got == [(1, 4, 0, text), (1, 4, 0, text), (2, 5, 4, "x"), (3, 0, 0, ""), (4, 0, 0, ""), (99, 4, 4, "")]


def test_items_of_equal_ids_count_once(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "d e f g")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c"), (7, "c d e"), (8, "c d e"), (7, "a b c"), (None, "d e f")], "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_hit, r.n_items) for r in find_leaks(df, bench, window=3).collect()))
    assert got == [(0, 3, 1), (1, 5, 2), (1, 5, 2)]
    assert got == sorted(((r.doc_id or 0, r.n_hit, r.n_items) for r in find_leaks(df, bench, window=3, most_bytes=60).collect()))


def test_mix_of_ties_and_null_ids(spark):
    rows = [(None, "w " * 5, "a")] * 40 + [(7, "w " * 5, "a")] * 40 + [(i, "v " * 5, "b") for i in range(100, 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixed(df, in_range=8, keep=["doc_id", "source"]).collect()
    assert len(out) == len(rows)
    times = {(r.row.doc_id, r.times) for r in out if r.row.source == "a"}
    assert len(times) == 2 and all(n <= 3 for _, n in times)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixed(df, in_range=8, keep=["doc_id", "source"]).collect()), key=repr)


def test_last_stage_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, start string"
    rows = [(1, None, None, None, None, "x"), (None, "a b c", None, "s", 3, None), (2, "", "en", "s", 0, "y"), (2, "", "en", "s", 0, "y"), (3, "long words " * 40_000, "en", None, 9, "z")]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    stage = corpus_pipeline.STAGES[-1][1]
    out = stage(spark, spark.createDataFrame(rows, schema), "").orderBy("start").collect()
    want = [len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x in [(None, "a b c"), (1, None), (2, ""), (2, ""), (3, rows[4][1])]]
    assert [(r.doc_id, r.n_tokens) for r in out] == list(zip([None, 1, 2, 2, 3], want, strict=True))
    assert [r.start for r in out] == [0, *np.cumsum(want)[:-1].tolist()]
    assert stage(spark, spark.createDataFrame([], schema), "").collect() == []
