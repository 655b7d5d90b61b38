import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from glyphmill.llm import token_files
from glyphmill.llm._tokens import Encoder
from glyphmill.llm.token_files import Reader, read_digests, read_documents, write_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def odd_texts(n):
    rnd = random.Random(n)
    parts = ["it's", " don't", " a", "b", "  ", "\n", "\n\n", "\t", " 12", "3.5", "é", " naïve", " ", "　", "漢字", " 漢", " x", "!?", " --", "'s", " 's", "\x1c", "​", "😀", " 😀", "<|endoftext|>", "\r\n", "à la", "ß ü", "﻿"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_pieces_give_the_ids_of_whole_texts():
    texts = odd_texts(400)
    ids, at = Encoder(PATH).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == plain(texts)
    assert Encoder(PATH).counts(pa.array(texts)).tolist() == [len(x) for x in plain(texts)]


def test_files_round_trip(spark, monkeypatch):
    texts = odd_texts(80)
    rows = [(7 * i % 83, t) for i, t in enumerate(texts)] + [(500, None), (501, "word " * 100_000), (3, texts[0]), (None, "x y")]
    df = spark.createDataFrame([(t, i, "s") for i, t in rows], "text string, doc_id long, start string").repartition(3)
    manifest = write_ids(df, PATH)
    got = read_digests(manifest).collect()
    want = {}
    for (i, _), ids in zip(rows, plain([t or "" for _, t in rows])):
        want.setdefault(i, []).append((len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(((i, *x) for i, xs in want.items() for x in xs), key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    files = [r.file for r in manifest.collect()]
    found = read_documents(files, [500, 501])
    assert found[500].tolist() == [0] and found[501].tolist() == [*plain(["word " * 100_000])[0], 0]
    assert read_digests(write_ids(df.limit(0), PATH)).collect() == []


def test_frames_stand_alone_and_damage_shows(spark, tmp_path):
    df = spark.range(300).selectExpr("id as doc_id", "repeat(concat('word ', id, ' '), 400) as text").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    file = write_ids(df, PATH, tmp_path.as_uri()).first().file
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    with token_files._open(file) as f:
        reader = Reader(f)
        assert len(reader.size) > 3 and reader.document(299)[-1] == 0
    path = file.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    whole = zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read()
    assert len(whole) == 2 * int(reader.start[-1])
    data[int(reader.begin[2]) + 40] ^= 255
    open(path, "wb").write(data)
    with token_files._open(file) as f, pytest.raises((ValueError, zstandard.ZstdError)):
        Reader(f).frame(2)
