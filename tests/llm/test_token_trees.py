"""Trees that are kept: counts after one edit and another are those of the edited texts, and little is encoded again."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from glyphmill.llm.token_counts import counts_from_trees, edited, token_counts, token_trees

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_edits_in_turn(spark, tmp_path):
    rnd = random.Random(5)
    words = ["the", "house", "of", "it's", "naïve", "漢字", "x9", "\n", "--", "street,", "<|endoftext|>", "tab\t", "  "]
    texts = {i: " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 5, 400, 3000]))) for i in range(30)}
    trees = token_trees(spark.createDataFrame([(i, t) for i, t in texts.items()] + [(99, None)], "doc_id long, text string"), PATH, added=True)
    t = Tokenizer.from_file(PATH)
    count = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    assert {r.doc_id: sum(r.counts) for r in trees.collect()} == {i: count(x) for i, x in texts.items()} | {99: 0}
    for turn in range(2):
        trees.write.mode("overwrite").parquet(str(tmp_path / f"trees{turn}"))
        trees = spark.read.parquet(str(tmp_path / f"trees{turn}"))
        edits = []
        for i, x in texts.items():
            if i % 3:
                cuts = sorted(rnd.sample(range(len(x) + 1), min(4, len(x) + 1) // 2 * 2))
                own = [(a, b, rnd.choice(["", "new", " and ", "\n"])) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
                edits += [(i, *e) for e in own]
                for a, b, new in reversed(own):
                    x = x[:a] + new + x[b:]
                texts[i] = x
        trees = edited(trees, spark.createDataFrame(edits, "doc_id long, start int, end int, new string"), PATH, added=True)
        got = {r.doc_id: r for r in trees.collect()}
        assert {i: r.text for i, r in got.items()} == texts | {99: ""}
        assert {i: r.n_tokens for i, r in got.items()} == {i: count(x) for i, x in texts.items()} | {99: 0}
        assert all(sum(r.counts) == r.n_tokens and sum(r.lengths) == len(r.text) for r in got.values())
        assert all(got[i].n_chars_encoded_again == 0 for i in texts if i % 3 == 0)
        assert sum(r.n_chars_encoded_again for r in got.values()) < sum(map(len, texts.values())) / 2
        trees = trees.select("doc_id", "text", "lengths", "counts")


SCHEMA = "doc_id long, text string, counts int, edits int, mark string"


def test_counts_from_kept_trees_like_one_pass(spark):
    rnd = random.Random(7)
    texts = ["", None, "plain words", "write to a.b@c.org or 1234567 now", "123456", "x@y.zz " * 300, "word " * 120_000 + "0123456789", *["it's 98765432 " * rnd.randint(0, 90) for _ in range(12)]]
    rows = [(rnd.choice([i, i, 4, None]), t) for i, t in enumerate(texts)]
    rows += [(4, texts[3]), (4, texts[4]), (None, texts[3]), (None, texts[5])] + [(50, texts[3])] * 30
    df = spark.createDataFrame([(i, t, 1, 2, "clash") for i, t in rows], SCHEMA).repartition(3)
    key = lambda r: repr(tuple(r))
    got = counts_from_trees(df, PATH, added=True).collect()
    assert len(got) == len(rows) and sorted(got, key=key) == sorted(token_counts(df, PATH, added=True).collect(), key=key)
    t = Tokenizer.from_file(PATH)
    plain = sorted((-1 if i is None else i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows)
    assert plain == sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got)
    assert sum(r.n_edits for r in got) > 300
    assert counts_from_trees(df.limit(0), PATH, added=True).collect() == []


def test_edits_of_odd_rows(spark):
    rows = [(1, "one two", 0, 0, ""), (1, "one two", 0, 0, ""), (2, None, 0, 0, ""), (None, "left alone", 0, 0, ""), (3, "", 0, 0, "")]
    trees = token_trees(spark.createDataFrame(rows, SCHEMA), PATH)
    edits = spark.createDataFrame([(1, 0, 3, "three", 9), (2, 0, 0, "new", 9), (None, 0, 4, "no", 9), (7, 0, 1, "nobody", 9)], "doc_id long, start int, end int, new string, text int")
    got = sorted(((r.doc_id or 0), r.text) for r in edited(trees, edits, PATH).collect())
    assert got == [(0, "left alone"), (1, "three two"), (1, "three two"), (2, "new"), (3, "")]
    assert edited(trees.limit(0), edits, PATH).collect() == [] and len(edited(trees, edits.limit(0), PATH).collect()) == 5
