"""Links, components and kept rows against all pairs, over planted groups, odd vectors and tiny chunks."""

import math
import random

import numpy as np
import pytest

from glyphmill.llm.vector_dedup import balls_of, near_vectors, unit

SCHEMA = "vec_id long, embedding array<double>, label int, n_links long, v int"


def plain(rows, least=0.9):
    dim = max([len(v) for _, v in rows if v] or [1])
    fine = [v is not None and any(x for x in v) and all(x is not None and math.isfinite(x) for x in v) for _, v in rows]
    x = [np.array(v + [0.0] * (dim - len(v))) if f else None for (_, v), f in zip(rows, fine)]
    n = len(rows)
    links = [[j for j in range(n) if j != i and fine[i] and fine[j] and x[i] @ x[j] / (math.sqrt(x[i] @ x[i]) * math.sqrt(x[j] @ x[j])) >= least] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), low, rows[i][0] == low))
    return out


def made(seed, n=220, dim=12, noise=(0.05, 0.12, 0.3)):
    rnd = np.random.default_rng(seed)
    rows = [(i, (rnd.normal(size=dim) * 10.0 ** rnd.integers(-3, 4)).tolist()) for i in range(n)]
    for c in range(4):
        center = rnd.normal(size=dim)
        rows += [(1000 + 100 * c + i, (center + rnd.normal(size=dim) * rnd.choice(noise)).tolist()) for i in range(40)]
    # A chain: each is linked with the next ones, not with all.
    rows += [(5000 + i, [math.cos(i / 4), math.sin(i / 4)] + [0.0] * (dim - 2)) for i in range(14)]
    rows += [rows[3], rows[3], (77, rows[4][1]), (None, rows[5][1]), (None, rows[5][1]), (None, [9.0] + [0.0] * (dim - 1))]
    rows += [(8000, None), (8001, []), (8002, [0.0] * dim), (8003, [1.0, None]), (8004, [math.nan] * dim), (8005, [math.inf] + [1.0] * (dim - 1)), (None, None), (8006, [1.0, 2.0]), (8007, [2.0, 4.0, 0.1])]
    random.Random(seed).shuffle(rows)
    return rows


def compared(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, 5, 6) for i, v in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in near_vectors(df, **how).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(rows)))
    return got


@pytest.mark.parametrize("held, sampled, salt", [(8192, 2000, 1 << 20), (16, 60, 50), (40, 400, 1 << 20), (1, 3, 1000)])
def test_like_all_pairs(spark, held, sampled, salt):
    rows = made(held)
    compared(spark, rows if held > 1 else rows[:60], held=held, most_sampled=sampled, in_salt=salt)


def test_exact_bound(spark):
    # The cosine of the first two is 90 / (10 * 10); the third misses it by one part in a million.
    rows = [(1, [10.0, 0.0, 0.0, 0.0]), (2, [9.0, 3.0, 3.0, 1.0]), (3, [9.0, 3.0, 3.0, 1.00005])]
    got = {r[0]: r[1] for r in compared(spark, rows)}
    assert got == {1: 1, 2: 2, 3: 1}


def test_one_large_tight_group_and_copies(spark):
    rnd = np.random.default_rng(2)
    center = rnd.normal(size=16)
    rows = [(i, (center + rnd.normal(size=16) * 0.05).tolist()) for i in range(300)] + [(400 + i, center.tolist()) for i in range(200)] + [(700 + i, rnd.normal(size=16).tolist()) for i in range(100)]
    compared(spark, rows, held=30, most_sampled=100)


def test_empty_and_hopeless(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [tuple(r) for r in near_vectors(spark.createDataFrame([(4, None, 1, 1, 1)], SCHEMA)).collect()] == [(4, 0, 4, True)]


def test_a_dense_place_becomes_a_ball():
    rnd = np.random.default_rng(1)
    center = unit(rnd.normal(size=(1, 32)))[0]
    u = unit(np.concatenate([center + rnd.normal(size=(30, 32)) * 0.03, rnd.normal(size=(100, 32))]))
    balls = balls_of(u, math.sqrt(0.2))
    assert len(balls) == 1 and balls[0] @ center > 0.99


@pytest.mark.parametrize("held, sampled", [(16, 60), (64, 400)])
def test_blocks_like_all_pairs(spark, held, sampled):
    compared(spark, made(held), held=held, most_sampled=sampled, copies=-1)


def test_even_vectors_are_not_dealt(spark, monkeypatch):
    # Vectors in all directions, in 16 chunks: dealt, each would go to 8 of them and be written as often.
    rnd = np.random.default_rng(5)
    monkeypatch.setattr("glyphmill.llm.vector_dedup._sent", None)
    compared(spark, [(i, rnd.normal(size=24).tolist()) for i in range(320)], held=20, most_sampled=100)
