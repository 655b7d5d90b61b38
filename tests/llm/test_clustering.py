"""Clusters against plain rounds over all centroids, and the annulus at its edges."""

import hashlib
import math
import random

import numpy as np
import pytest

from glyphmill.llm.clustering import MOST, Annulus, clustered

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int"


def plain(rows, k, rounds, dim, scale=1024):
    kept = [(i, [max(-MOST, min(MOST, math.floor(scale * x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    draw = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in draw[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cents)]
    near = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = {}
    for _, j, d in near:
        own[j] = own.get(j, 0) + d
    total = sum(own.values())
    return [(i, j, d, own[j], total, hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, j, d in near]


def compared(spark, rows, k=4, rounds=5, dim=5):
    df = spark.createDataFrame([(i, v, 1, 9) for i, v in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in clustered(df, k=k, rounds=rounds, dim=dim).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(rows, k, rounds, dim)))
    return got


@pytest.mark.parametrize("k", [1, 4, 40])
def test_like_plain_rounds(spark, k):
    rnd = random.Random(k)
    rows = [(rnd.choice([i, i, 7, None]), [rnd.gauss(0, 1) for _ in range(5)]) for i in range(150)]
    rows += [(900, None), (901, []), (902, [1.0]), (903, [1.0, 2.0, None, 0.0, 1.0]), (904, [math.nan] * 5), (905, [math.inf] * 5), (906, [0.0] * 5), (907, [0.0] * 5)]
    compared(spark, rows + rows[:5], k)


def test_ties_and_copies(spark):
    rows = [(i, [float(x) for x in np.eye(5)[i % 5]]) for i in range(40)] + [(50 + i, [0.5] * 5) for i in range(30)]
    assert len(compared(spark, rows, 3)) == 70


def test_few_none_and_extreme(spark):
    assert len(compared(spark, [(1, [1.0] * 5), (2, [2.0] * 5)], 8)) == 2
    assert clustered(spark.createDataFrame([], SCHEMA), dim=5).collect() == []
    assert clustered(spark.createDataFrame([(1, None, 1, 1)], SCHEMA), dim=5).collect() == []
    compared(spark, [(i, [1e30, -1e30, 1e5 * i, -0.0, 1e-30]) for i in range(12)], 3)


def test_annulus_compares_ties_at_its_edge():
    rnd = np.random.default_rng(4)
    for size in (3, 1 << 20, 1 << 24):
        cents = rnd.integers(-size, size, (30, 6))
        cents[7], cents[20] = cents[3], -cents[3]
        x = np.concatenate([rnd.integers(-size, size, (200, 6)), cents, np.zeros((2, 6), int), (cents[:10] + cents[10:20]) // 2])
        number, d = Annulus(cents.tolist()).nearest(x)
        want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents.tolist())) for v in x.tolist()]
        assert list(zip(d.tolist(), number.tolist())) == want
