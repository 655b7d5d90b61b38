"""op5, op10 and the pipeline's last stage give what the library gives by default where a text holds an added token's text."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from glyphmill.llm._tokens import encoder
from glyphmill.llm.queries import queries
from glyphmill.llm.token_counts import Tree, as_rows, leaf_bounds

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["<|endoftext|>", "<|endoftext|>", "<|endof", "text|>", "|>", "<", " a", "b", "  ", "\n", " 12", "é", "漢字", "!?", "'s", " word"]


LIBRARY = Tokenizer.from_file(PATH)


def plain(texts):
    return [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def odd_texts(n, most=40):
    rnd = random.Random(n)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def test_ids_are_the_librarys():
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> y", "<|endoftext", "|>", *odd_texts(400)]
    assert plain(texts)[1] == [50256]
    ids, at = encoder(PATH, added=True).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == plain(texts)


def test_trees_follow_edits_over_added_tokens():
    rnd, enc = random.Random(6), encoder(PATH, added=True)
    count = lambda texts: [len(x) for x in plain(texts)]
    for text in odd_texts(60, 60):
        buf, bounds, _ = leaf_bounds(pa.array([text]), least=5, whole=enc.whole)
        leaves = as_rows(buf, bounds).to_pylist() if len(bounds) > 1 else []
        tree = Tree(leaves, count(leaves) if leaves else [], enc.whole)
        assert tree.counts.total == count([text])[0]
        for _ in range(15):
            a = rnd.randint(0, len(text))
            b = min(len(text), a + rnd.choice([0, 0, 1, 2, 5, 30]))
            new = "".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 0, 1, 3])))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            dirty = sorted(tree.dirty)
            tree.put(dict(zip(dirty, count([tree.leaves[i] for i in dirty]) if dirty else [])))
            assert tree.text() == text and tree.counts.total == count([text])[0]


@pytest.fixture(scope="module")
def texts():
    return ["one<|endoftext|>two", *odd_texts(60)]


def test_op10_and_pipeline(spark, tmp_path, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = {i: (len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for i, x in enumerate(plain(texts))}
    start = np.cumsum([0, *[n for n, _ in want.values()]]).tolist()
    for got in (queries()["op10_token_files"](spark, str(tmp_path)), corpus_pipeline.write_tokens(spark, df, "")):
        assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got.collect()} == {i: (start[i], *x) for i, x in want.items()}


def test_op5(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in queries()["op5_token_counts"](spark, str(tmp_path)).collect()}
    assert got == {i: len(x) for i, x in enumerate(plain(texts))}
