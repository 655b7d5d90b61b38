import hashlib
import random
import re

from glyphmill.llm.substring_dedup import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    ids = [float("inf") if i is None else i for i, _ in rows]
    first = {}
    for i, w in zip(ids, words):
        for j in range(len(w) - width + 1):
            k = tuple(w[j : j + width])
            first[k] = min(first.get(k, float("inf")), i)
    out = []
    for (doc, _), i, w in zip(rows, ids, words):
        gone = set()
        for j in range(len(w) - width + 1):
            if first[tuple(w[j : j + width])] < i:
                gone.update(range(j, j + width))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def made(seed, n=60):
    rnd = random.Random(seed)
    vocab = ["a", "b", "ü", "naïve", "x y", "漢字", "The", "the"]
    shared = [[rnd.choice(vocab) for _ in range(rnd.randint(13, 40))] for _ in range(4)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocab) + str(rnd.randint(0, 300)) for _ in range(rnd.randint(0, 60))]
        for s in rnd.sample(shared, rnd.randint(0, 2)):
            at = rnd.randint(0, len(words))
            words[at:at] = s
        rows.append((i, "".join(w + rnd.choice([" ", "\n", "\t", "  ", "\x0b"]) for w in words)))
    return rows + [(3, rows[3][1]), (5, rows[9][1]), (None, rows[4][1]), (100, None), (101, ""), (102, rows[1][1] * 50)]


def test_like_brute_force(spark):
    for seed, parts in ((1, 1), (2, 5)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = made(seed)
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, at int").repartition(3)
        got = substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 13), key=key)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_of_one_id_whose_texts_share_a_crc32(spark):
    p, q = " ".join(f"p{i}" for i in range(15)), " ".join(f"q{i}" for i in range(40))
    rows = [(1, p), (None, p + " f2d3e4ae88"), (None, q + " c6c14d7786")]
    for ids in ((1, None, None), (1, 5, 5)):
        some = [(i, t) for i, (_, t) in zip(ids, rows, strict=True)]
        df = spark.createDataFrame(some, "doc_id long, text string")
        got = sorted((r.n_words, r.n_removed) for r in substring_dedup(df).collect())
        assert got == [(15, 0), (16, 15), (41, 0)]


def test_the_largest_id_counts_as_null(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([((1 << 63) - 1, text), (None, text + " x"), ((1 << 63) - 2, text + " y")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup(df).collect()}
    assert got == {(1 << 63) - 1: 20, None: 20, (1 << 63) - 2: 0}
