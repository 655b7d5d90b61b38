import random

import public_tokenizers
import pyarrow as pa

from glyphmill.llm._tokens import encoder
from glyphmill.llm.token_counts import Tree, as_rows, leaf_bounds, private, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["it's", " don't", " a", "b", "  ", "\n", "\t", " 12", "é", " naïve", "　", "漢字", " x", "!?", "'s", " 's", " ", "ß ü", "word"]


def test_trees_follow_edits():
    rnd, enc = random.Random(5), encoder(PATH)
    count = lambda texts: enc.counts(pa.array(texts, pa.string())).tolist()
    for _ in range(60):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 200)))
        buf, bounds, first = leaf_bounds(pa.array([text]), least=24)
        leaves = as_rows(buf, bounds).to_pylist() if len(bounds) > 1 else []
        assert "".join(leaves) == text
        tree = Tree(leaves, count(leaves) if leaves else [])
        assert tree.counts.total == count([text])[0]
        for _ in range(15):
            a = rnd.randint(0, len(text))
            b = min(len(text), a + rnd.choice([0, 0, 1, 2, 30, 200]))
            new = "".join(rnd.choice(PARTS) for _ in range(rnd.choice([0, 0, 1, 3])))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            dirty = sorted(tree.dirty)
            tree.put(dict(zip(dirty, count([tree.leaves[i] for i in dirty]) if dirty else [])))
            assert tree.text() == text and tree.counts.total == count([text])[0]


def test_like_encoding_twice(spark):
    enc = encoder(PATH)
    texts = ["mail me@x.example.org or 12345678 now", "", None, "plain", "a@b.cd", "x" * 3000 + " 1234567 " + "word " * 30000, "1234567 8901234 a@b.cd"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 2)], "doc_id long, text string, n_tokens int")
    for r in token_counts(df, PATH).collect():
        text = texts[r.doc_id] or ""
        new, last = "", 0
        for a, b, x in private(text):
            new, last = new + text[last:a] + x, b
        new += text[last:]
        want = enc.counts(pa.array([text, new], pa.string())).tolist()
        assert [r.n_tokens, r.n_tokens_edited] == want and r.n_edits == len(private(text))
        assert r.n_chars_encoded_again <= 5000
    assert token_counts(df, PATH).count() == len(texts) + 1 and token_counts(df.limit(0), PATH).collect() == []
