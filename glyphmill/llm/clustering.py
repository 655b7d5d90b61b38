"""Centroid clustering: Lloyd's rounds in exact integers, the nearest centroid found by annulus search.

Centroids are sorted by norm. The distance of a vector to the centroid of the nearest norm bounds that to its nearest one, and a centroid
within that bound has a norm within it of the vector's own; so binary search in the norms gives the run of centroids that can be nearest,
a little widened so that ties at its edges are in it, and only those are compared, exactly. Tasks send sums of a centroid's vectors, one row for
each centroid and task, which Spark adds; the driver gets centroids times components numbers, whatever the number of vectors.

Defined cases: vectors with another number of components, and those that are null or hold null or non-finite ones, are left out.
Components are integers, ``floor(scale * x)``; beyond 2^27 they are taken as 2^27, as squared distances are longs. A null
vec_id is written as nothing in the hash that draws the first centroids; equal hashes go by the components. With fewer vectors than
centroids each vector starts one; a table without vectors gives no rows. Repeated rows count each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._work import small_batches, stored

MOST = 1 << 27
#: Up to this size of components, squared distances of 64 of them are exact in floating point.
EXACT = 1 << 22


def whole_vectors(rows: DataFrame, dim: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors with ``dim`` finite components, as integers."""
    x = F.col("embedding")
    fine = (F.size(x) == dim) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(c.cast("double") * scale))).cast("int"))
    return rows.where(F.coalesce(fine, F.lit(False))).select("vec_id", whole.alias("v"))


class Annulus:
    """Centroids sorted by norm, for nearest(): numbers are those of the rows given."""

    def __init__(self, centroids: list[list[int]]):
        self.rows = np.array(centroids, np.int64)
        norms = np.sqrt((self.rows.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        self.largest = int(np.abs(self.rows).max())

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row of integers, the smallest number of equally near ones, and the squared distance."""
        kind = np.float64 if max(self.largest, int(np.abs(x).max(initial=0))) <= EXACT and x.shape[1] <= 64 else np.int64
        x, centroids = x.astype(kind), self.rows[self.order].astype(kind)
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        at = np.searchsorted(self.norms, norm)
        before = np.maximum(at - 1, 0)
        after = np.minimum(at, len(centroids) - 1)
        first = np.where(norm - self.norms[before] <= self.norms[after] - norm, before, after)
        bound = np.sqrt(((x - centroids[first]) ** 2).sum(1).astype(np.float64))
        wide = bound + 1e-6 * (1 + norm + bound)
        lo, hi = np.searchsorted(self.norms, norm - wide, "left"), np.searchsorted(self.norms, norm + wide, "right")
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.full(len(x), len(centroids), np.int64)
        for j in range(int(lo.min(initial=0)), int(hi.max(initial=0))):
            own = np.flatnonzero((lo <= j) & (j < hi))
            d = ((x[own] - centroids[j]) ** 2).sum(1).astype(np.int64)
            less = (d < best[own]) | ((d == best[own]) & (self.order[j] < number[own]))
            best[own[less]], number[own[less]] = d[less], self.order[j]
        return number, best


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(index: Annulus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros_like(index.rows), np.zeros(len(index.rows), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v")).astype(np.int64)
                number, _ = index.nearest(x)
                order = np.argsort(number, kind="stable")
                edge = np.flatnonzero(np.diff(number[order], prepend=-1))
                own = number[order][edge]
                sums[own] += np.add.reduceat(x[order], edge, axis=0)
                count += np.bincount(number, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def _assigned(index: Annulus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, d = index.nearest(_matrix(batch.column("v")).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    return run


def centroids_of(vectors: DataFrame, first: list[list[int]], rounds: int) -> list[list[int]]:
    """The centroids after so many rounds. In a round a centroid becomes the floor of its vectors' mean; one without vectors stays."""
    found = [list(c) for c in first]
    for _ in range(rounds):
        parts = vectors.select("v").mapInArrow(_sums(Annulus(found)), "cluster long, n long, sums array<long>")
        by_place = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        for row in by_place.collect():
            found[row["cluster"]][row["at"]] = row["s"] // row["n"]
    return found


def clustered(rows: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector of rows (vec_id, embedding)."""
    spark = rows.sparkSession
    small_batches(spark)
    vectors = stored(whole_vectors(rows, dim, scale), "vectors")
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = [list(r["v"]) for r in vectors.orderBy(draw, "v").limit(k).select("v").collect()]
    kind = dict(rows.dtypes)["vec_id"]
    if not first:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    found = centroids_of(vectors, first, rounds)
    near = stored(vectors.mapInArrow(_assigned(Annulus(found)), f"vec_id {kind}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["s"] for r in near.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    said = [(i, sums[i], sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(found) if i in sums]
    figures = spark.createDataFrame(said, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return near.join(F.broadcast(figures), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
