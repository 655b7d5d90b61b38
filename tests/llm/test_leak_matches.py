"""The matches themselves, and that op3's figures follow from them."""

import hashlib

from glyphmill.llm.decontaminate import find_leaks, leak_matches

SF = "/root/testdata/sf0.001"


def test_matches_give_the_figures(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {r.doc_id: r for r in find_leaks(docs, bench).collect() if r.contaminated}
    for most in (16 << 20, 4000):
        got: dict = {}
        for r in leak_matches(docs, bench, most_bytes=most).collect():
            assert r.exact and 0 <= r.first < r.last
            words, items = got.setdefault(r.doc_id, (set(), set()))
            words.update(range(r.first, r.last))
            items.add(r.item_id)
        assert got.keys() == want.keys() and got
        for i, (words, items) in got.items():
            digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
            assert (len(words), len(items), digest) == (want[i].n_hit, want[i].n_items, want[i].items_sha256)


def test_places_exact_and_near(spark):
    df = spark.createDataFrame([(1, "x a b q c d y"), (2, "d c b a"), (3, "a b c"), (4, "z A, b c d"), (5, None)], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b c d"), (2, "a b c d e")], "item_id long, text string")
    assert sorted(map(tuple, leak_matches(df, item, window=4).collect())) == [(4, "1", 1, 5, True), (4, "2", 1, 5, True)]
    near = {(r.doc_id, r.item_id, r.exact) for r in leak_matches(df, item, window=4, slop=1).collect()}
    assert {(i, e) for i, x, e in near if x == "1"} == {(1, False), (2, False), (4, True)}
    assert leak_matches(df, item.limit(0), window=4).collect() == []
