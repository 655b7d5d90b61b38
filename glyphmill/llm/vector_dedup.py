"""Embedding near-dedup: an exact range join of vectors by cosine, over cells of pivots.

For unit vectors cosine is a matter of distance: a cosine of c is a chord of sqrt(2 - 2c), and chords obey the triangle inequality. A
bounded sample of the vectors gives pivots of two kinds. Balls stand where the sample is dense; who is within half the radius of a ball's pivot
belongs to it, so all of its vectors are linked with each other, and a group of near copies of any size takes counts and no pairs. All
other vectors belong to the cell of their nearest pivot. A vector meets its own cell, and of the cells after it those whose border it may
reach: no farther from their pivot than the cell's radius and the join's together, nor, between cells of nearest pivots, than its own
pivot and twice the join's radius. So every pair meets in exactly one cell. A cell's vectors are dealt to chunks of bounded size; a task holds one chunk
while the vectors that it meets stream by, in order of their distance to the pivot, so that only a window of the chunk is compared.

Vectors that lie evenly meet most cells, whatever the pivots. Where it is counted that more than ``copies`` of a vector, on the average, would go to other
chunks, nothing is dealt: vectors are written once in blocks, and Spark's product of the blocks with themselves reads them again for each task,
so what is on disk grows with the vectors and not with their pairs.

A comparison is a product of float matrices. It begins with the few directions in which the sample has most of its length: the product there and that of the
lengths of what is left are a bound on the cosine. What may be linked by it is computed in double precision. Tasks
send counts of links, and edges of spanning forests only, so components never need all pairs.

The sample (``most_sampled`` vectors of smallest hash) decides how the work is dealt and never the result.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components link with nothing. The shorter of two
vectors of different length counts as if it ended in zeros. Rows of equal vec_id are vectors of their own; a component's id is the smallest one that isn't
null, and a row is kept if its vec_id is that (or both are null). Repeated rows link with each other. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.llm._work import LARGE_ROWS, components, drop_stored, meet, small_batches, stored

#: A bound on the error of a product of unit vectors in single precision, and on that of a distance in double precision.
LOOSE, SLACK = 5e-5, 1e-6


@dataclass(frozen=True)
class Cells:
    """Pivots: those of cells, then those of balls. reach: the largest distance of a vector of each cell to its pivot, chunks: its number of chunks, 0
    where it has no vectors. basis: directions that bound cosines, None if only all do."""

    pivots: np.ndarray
    n_cells: int
    radius: float
    reach: np.ndarray | None = None
    chunks: np.ndarray | None = None
    basis: np.ndarray | None = None


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows, zeros at the end of shorter ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(column), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def chords(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (u @ pivots.T)))


def balls_of(u: np.ndarray, radius: float, least: int = 4, most: int = 64) -> np.ndarray:
    """Pivots where the sample is dense: the mean of the vectors within the radius of one, as long as ``least`` of them and more are left."""
    found, left = [], np.arange(len(u))
    near = chords(u, u) <= radius if len(u) else np.zeros((0, 0), bool)
    while len(left) and len(found) < most:
        count = near[np.ix_(left, left)].sum(1)
        at = int(np.argmax(count))
        if count[at] < least:
            break
        own = near[left[at], left]
        mean = u[left[own]].mean(0)
        if (size := np.sqrt((mean * mean).sum())) > 0.5:
            found.append(mean / size)
        left = left[~own]
    return np.array(found).reshape(-1, u.shape[1])


def heads(u: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors in the directions of a basis, and the length of what is left: a product of two such rows is their cosine or more."""
    y = u @ basis
    return np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1, keepdims=True)))], 1).astype(np.float32)


def basis_of(u: np.ndarray, least: float) -> np.ndarray | None:
    """As few of the sample's main directions as leave one in 2,000 of its pairs open."""
    u = u[:1000]
    if len(u) < 2:
        return None
    q = np.linalg.eigh(u.T @ u)[1][:, ::-1]
    for k in range(8, u.shape[1] * 3 // 4 + 1, 8):
        h = heads(u, q[:, :k])
        if ((h @ h.T >= least - LOOSE).sum() - len(u)) * 2000 <= len(u) * (len(u) - 1):
            return np.ascontiguousarray(q[:, :k])
    return None


def cells_of(sample: np.ndarray, weight: int, held: int, radius: float) -> Cells:
    """Balls, and as many other pivots as pay: with four times as many cells a vector must not meet more chunks than before."""
    balls = balls_of(sample, radius)
    rest = sample[(chords(sample, balls) > radius / 2).all(1)] if len(balls) else sample
    least = max(1, math.ceil(weight / held))
    pivots = rest[:1] if len(rest) else sample[:1]
    for n in (least, 4 * least, 16 * least):
        some = rest[: min(n, len(rest), 4096)]
        if len(some) <= len(pivots):
            continue
        d = chords(rest, some)
        home = d.argmin(1)
        own = d[np.arange(len(d)), home]
        reach = np.zeros(len(some))
        np.maximum.at(reach, home, own)
        met = (d <= np.minimum(reach + radius, own[:, None] + 2 * radius)).sum(1).mean()
        if n == least or met <= 2 * least:
            pivots = some
    return Cells(np.concatenate([pivots, balls]), len(pivots), radius, basis=basis_of(rest, 1 - radius**2 / 2))


def _home(u: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances to all pivots, the cell or ball of each vector, and the distance to its pivot."""
    d = chords(u, cells.pivots)
    home = d[:, : cells.n_cells].argmin(1)
    if len(cells.pivots) > cells.n_cells:
        ball = cells.n_cells + d[:, cells.n_cells :].argmin(1)
        home = np.where(d[np.arange(len(d)), ball] <= cells.radius / 2 - SLACK, ball, home)
    return d, home, d[np.arange(len(d)), home]


def _placed(cells: Cells, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, home, own = _home(unit(matrix(batch.column("v"), dim)), cells)
                yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(home.astype(np.int32)), pa.array(own)], names=["rid", "cell", "d"])

    return run


def _meets(d: np.ndarray, home: np.ndarray, own: np.ndarray, j: int, cells: Cells) -> np.ndarray:
    """Which vectors of earlier cells meet the cell j."""
    meets = (home < j) & (d[:, j] <= cells.reach[j] + cells.radius + SLACK)
    if j < cells.n_cells:
        meets &= d[:, j] <= own + 2 * cells.radius + SLACK
    return meets


def _copies(cells: Cells, dim: int):
    """To how many chunks besides their own the vectors of each batch go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d, home, own = _home(unit(matrix(batch.column("v"), dim)), cells)
                inner = np.where(home < cells.n_cells, (cells.chunks[home] - 1) / 2, 0).sum()
                n = inner + sum(cells.chunks[j] * _meets(d, home, own, j, cells).sum() for j in range(len(cells.pivots)))
                yield pa.RecordBatch.from_arrays([pa.array([float(n)])], names=["n"])

    return run


def _sent(cells: Cells, dim: int, salts: int):
    """Each vector to its chunk (role 0) and to the chunks that it meets (role 1): those after its own in its cell, but not in a ball, and
    all of the later cells that it may reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rid = batch.column("rid").to_numpy()
            d, home, own = _home(unit(matrix(batch.column("v"), dim)), cells)
            spread = (rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            chunk = (spread % np.maximum(cells.chunks[home], 1).astype(np.uint64)).astype(np.int64)
            salt = ((spread >> np.uint64(7)) % np.uint64(salts)).astype(np.int64)
            out: list[tuple] = [(np.arange(len(rid)), home, chunk, np.full(len(rid), s), np.zeros(len(rid), np.int64), own) for s in range(salts)]
            for j in range(len(cells.pivots)):
                meets = _meets(d, home, own, j, cells)
                for c in range(int(cells.chunks[j])):
                    at = np.flatnonzero(meets | (home == j) & (chunk < c) if j < cells.n_cells else meets)
                    if len(at):
                        out.append((at, np.full(len(at), j), np.full(len(at), c), salt[at], np.ones(len(at), np.int64), d[at, j]))
            at, cell, chunk_, salt_, role, dist = (np.concatenate([x[i] for x in out]) for i in range(6))
            for lo in range(0, len(at), 8192):
                s = slice(lo, lo + 8192)
                some = batch.take(pa.array(at[s]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[s].astype(np.int32)), pa.array(chunk_[s].astype(np.int32)), pa.array(salt_[s].astype(np.int32)), pa.array(role[s].astype(np.int32)), pa.array(dist[s]), some.column("rid"), some.column("v")],
                    names=["cell", "chunk", "salt", "role", "d", "rid", "v"],
                )

    return run


BLOCKS = "no long, rid binary, ball binary, x binary"


def _blocks(cells: Cells, dim: int, held: int, kind: str):
    """Vectors as they come in rows of ``held``, in the order of their balls (-1: none). no is the smallest number in a row."""

    def row(some: list[tuple]) -> pa.RecordBatch:
        rid, ball, x = (np.concatenate([p[i] for p in some]) for i in range(3))
        order = np.argsort(ball, kind="stable")
        data = [pa.array([y[order].tobytes()], pa.binary()) for y in (rid, ball, x)]
        return pa.RecordBatch.from_arrays([pa.array([int(rid.min())]), *data], names=["no", "rid", "ball", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"), dim)
            home = _home(unit(x), cells)[1]
            whole = batch.column("rid").to_numpy(), np.where(home >= cells.n_cells, home, -1).astype(np.int64), x.astype(kind)
            at = 0
            while at < len(x):
                stop = min(len(x), at + held - n)
                parts.append(tuple(y[at:stop] for y in whole))
                n, at = n + stop - at, stop
                if n == held:
                    yield row(parts)
                    parts, n = [], 0
        if parts:
            yield row(parts)

    return run


class _Chunk:
    """The vectors that a task holds. links: of each held vector; parent: a forest over held vectors. Vectors of one ball aren't compared."""

    def __init__(self, parts: list[tuple], cells: Cells, least: float):
        self.rid, self.x, self.d, self.ball = (np.concatenate([p[i] for p in parts]) for i in range(4))
        order = np.argsort(self.d, kind="stable")
        self.rid, self.x, self.d, self.ball = self.rid[order], self.x[order], self.d[order], self.ball[order]
        self.u = unit(self.x)
        self.basis = cells.basis
        self.u32 = self.u.astype(np.float32)
        self.head = self.u32 if self.basis is None else heads(self.u, self.basis)
        self.links = np.zeros(len(self.rid), np.int64)
        self.parent = np.arange(len(self.rid))
        self.least, self.radius = least, cells.radius

    def _root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def _flat(self) -> None:
        while not np.array_equal(further := self.parent[self.parent], self.parent):
            self.parent = further

    def _exact(self, x: np.ndarray, u: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether pairs are linked, in double precision."""
        found = np.zeros(len(i), bool)
        for lo in range(0, len(i), 16384):
            s = slice(lo, lo + 16384)
            a, b = x[i[s]], self.x[j[s]]
            if max(np.abs(a).max(), np.abs(b).max()) > 1e100 or min(np.abs(a).max(1).min(), np.abs(b).max(1).min()) < 1e-100:
                a, b = u[i[s]], self.u[j[s]]
            cosine = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
            found[s] = cosine >= self.least
        return found

    def _linked(self, x: np.ndarray, u: np.ndarray, ball: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of vectors and those held from lo to hi that are linked, in the order of the first."""
        u32 = u.astype(np.float32)
        head = u32 if self.basis is None else heads(u, self.basis)
        balls = [b for b in np.unique(ball) if b >= 0]
        out = []
        for c in range(lo, hi, 2048):
            stop = min(hi, c + 2048)
            own = [(np.flatnonzero(ball == b)[:, None], np.flatnonzero(self.ball[c:stop] == b)) for b in balls]

            def open_(near: np.ndarray, own: list[tuple] = own) -> np.ndarray:
                for at in own:
                    near[at] = -2
                return np.flatnonzero(near.ravel() >= self.least - LOOSE)

            near = head @ self.head[c:stop].T
            at = open_(near)
            whole = self.basis is None
            if not whole and 8 * len(at) > near.size:
                near = u32 @ self.u32[c:stop].T
                at, whole = open_(near), True
            if not len(at):
                continue
            i, j = np.divmod(at, stop - c)
            sure = near.ravel()[at] >= self.least + LOOSE if whole else np.zeros(len(at), bool)
            rest = np.flatnonzero(~sure)
            sure[rest] = self._exact(x, u, i[rest], j[rest] + c)
            out.append((i[sure], j[sure] + c))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i, j = (np.concatenate([o[k] for o in out]) for k in range(2))
        order = np.argsort(i, kind="stable")
        return i[order], j[order]

    def _join(self, rows: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Held vectors that one vector is linked with become one tree; a root for each of n vectors with links, -1 for others."""
        out = np.full(n, -1)
        if not len(rows):
            return out
        edge = np.flatnonzero(np.diff(rows, prepend=-1))
        while True:
            self._flat()
            labels = self.parent[at]
            low, high = np.minimum.reduceat(labels, edge), np.maximum.reduceat(labels, edge)
            apart = np.unique(np.stack([low, high], 1)[low < high], axis=0)
            if not len(apart):
                break
            for a, b in apart.tolist():
                a, b = self._root(a), self._root(b)
                self.parent[max(a, b)] = min(a, b)
        out[rows[edge]] = low
        return out

    def inside(self) -> None:
        """Pairs of held vectors."""
        for lo in range(0, len(self.rid), 512):
            rows = slice(lo, lo + 512)
            a, b = np.searchsorted(self.d, [self.d[rows][0] - self.radius - SLACK, self.d[rows][-1] + self.radius + SLACK])
            i, j = self._linked(self.x[rows], self.u[rows], self.ball[rows], a, b)
            other = i + lo != j
            i, j = i[other], j[other]
            n = len(self.rid[rows])
            self.links[rows] += np.bincount(i, minlength=n)
            # Each is its own neighbour, so its tree takes it in.
            own = np.flatnonzero(np.bincount(i, minlength=n))
            i, j = np.r_[i, own], np.r_[j, own + lo]
            order = np.argsort(i, kind="stable")
            self._join(i[order], j[order], n)

    def meet(self, rid: np.ndarray, x: np.ndarray, d: np.ndarray, ball: np.ndarray) -> Iterator[tuple]:
        """Vectors against those held: (rid, links), and (rid, a held one's rid) where there are any."""
        order = np.argsort(d, kind="stable")
        for lo in range(0, len(order), 512):
            own = order[lo : lo + 512]
            a, b = np.searchsorted(self.d, [d[own[0]] - self.radius - SLACK, d[own[-1]] + self.radius + SLACK])
            if a == b:
                continue
            i, j = self._linked(x[own], unit(x[own]), ball[own], a, b)
            self.links += np.bincount(j, minlength=len(self.rid))
            root = self._join(i, j, len(own))
            hit = np.flatnonzero(root >= 0)
            if len(hit):
                yield rid[own[hit]], np.bincount(i, minlength=len(own))[hit], self.rid[root[hit]]

    def rest(self) -> Iterator[tuple]:
        self._flat()
        yield self.rid, self.links, self.rid[self.parent]


def _answers(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    for rid, links, other in rows:
        some = np.flatnonzero((links > 0) | (rid != other))
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(links[some]), pa.array(other[some])], names=["rid", "links", "other"])


def _compared(cells: Cells, dim: int, least: float):
    def ended(parts: list[tuple], chunk: _Chunk | None, key: tuple) -> Iterator[pa.RecordBatch]:
        """What a chunk has found; its own pairs count once, not in each salt."""
        if chunk is None and parts and key[2] == 0 and key[0] < cells.n_cells:
            chunk = _Chunk(parts, cells, least)
            chunk.inside()
        if chunk is not None:
            yield from _answers(chunk.rest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        parts: list[tuple] = []
        chunk: _Chunk | None = None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("cell", "chunk", "salt", "role")], 1)
            edge = [*np.flatnonzero((np.diff(names, axis=0, prepend=names[:1] - 1) != 0).any(1)).tolist(), len(names)]
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                now = tuple(names[a, :3].tolist())
                if now != key:
                    if key is not None:
                        yield from ended(parts, chunk, key)
                    key, parts, chunk = now, [], None
                some = batch.slice(a, b - a)
                rows = some.column("rid").to_numpy(), matrix(some.column("v"), dim), some.column("d").to_numpy(), np.full(b - a, -1)
                if names[a, 3] == 0:
                    parts.append(rows)
                elif parts or chunk is not None:
                    if chunk is None:
                        chunk, parts = _Chunk(parts, cells, least), []
                        if key[2] == 0 and key[0] < cells.n_cells:
                            chunk.inside()
                    yield from _answers(chunk.meet(*rows))
        if key is not None:
            yield from ended(parts, chunk, key)

    return run


def _multiplied(cells: Cells, dim: int, least: float, kind: str):
    """Pairs of blocks, all of one left block in a row."""

    def vectors(batch: pa.RecordBatch, side: str, at: int) -> tuple:
        rid, ball, x = (np.frombuffer(batch.column(f"{side}_{c}")[at].as_buffer(), k) for c, k in (("rid", np.int64), ("ball", np.int64), ("x", kind)))
        return rid, x.reshape(-1, dim).astype(np.float64), np.zeros(len(rid)), ball

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, chunk = None, None
        for batch in batches:
            for at, (a, b) in enumerate(zip(batch.column("a_no").to_pylist(), batch.column("b_no").to_pylist(), strict=True)):
                if a != of:
                    if chunk is not None:
                        yield from _answers(chunk.rest())
                    of, chunk = a, _Chunk([vectors(batch, "a", at)], cells, least)
                if a == b:
                    chunk.inside()
                else:
                    yield from _answers(chunk.meet(*vectors(batch, "b", at)))
        if chunk is not None:
            yield from _answers(chunk.rest())

    return run


def near_vectors(rows: DataFrame, least: float = 0.9, held: int = 8192, most_sampled: int = 2000, in_salt: int = 1 << 20, copies: float = 0.5) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row (vec_id, embedding). Linked are vectors whose cosine is ``least`` or more,
    which must be above 0.5. held: vectors that a task holds; in_salt: about the most that it compares with them; copies: how many of a vector
    may be dealt to other chunks."""
    spark = rows.sparkSession
    small_batches(spark)
    x = F.col("embedding")
    fine = F.exists(x, lambda c: c != 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.select("vec_id", F.when(F.coalesce(fine, F.lit(False)), x).alias("v"))
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    vectors = stored(rows.where("v is not null").withColumn("rid", F.monotonically_increasing_id()), "vectors")
    total, dim = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        return alone.withColumn("kept", F.lit(True))
    radius = math.sqrt(2 - 2 * least)
    kind = vectors.schema["v"].dataType.simpleString()
    sample = unit(matrix(vectors.orderBy(F.xxhash64("rid"), "rid").limit(most_sampled).select("v").toArrow().column("v"), dim))
    cells = cells_of(sample, total, held, radius)
    placed = stored(vectors.select("rid", "v").mapInArrow(_placed(cells, dim), "rid long, cell int, d double"), "cells")
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(F.max("d").alias("reach"), F.count("*").alias("n"), F.min("rid").alias("rid")).collect()}
    reach, chunks = np.zeros(len(cells.pivots)), np.zeros(len(cells.pivots), np.int64)
    for cell, r in stats.items():
        reach[cell], chunks[cell] = r["reach"], math.ceil(r["n"] / held)
    cells = replace(cells, reach=reach, chunks=chunks)
    salts = max(1, math.ceil(total / in_salt))
    others = vectors.select("v").mapInArrow(_copies(cells, dim), "n double").agg(F.sum("n")).first()[0] / total
    if others + salts - 1 <= copies:
        tasks = max(1, min(int(chunks.sum()) * salts, 10_000))
        sent = vectors.select("rid", "v").mapInArrow(_sent(cells, dim, salts), f"cell int, chunk int, salt int, role int, d double, rid long, v {kind}")
        dealt = sent.repartition(tasks, "cell", "chunk", "salt").sortWithinPartitions("cell", "chunk", "salt", "role")
        met = dealt.mapInArrow(_compared(cells, dim, least), "rid long, links long, other long")
    else:
        number = "<f4" if kind == "array<float>" else "<f8"
        blocks = stored(vectors.select("rid", "v").mapInArrow(_blocks(cells, dim, held, number), BLOCKS), "blocks", **LARGE_ROWS)
        a, b = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
        pairs = a.hint("shuffle_replicate_nl").join(b, F.col("a_no") <= F.col("b_no"))
        met = pairs.mapInArrow(_multiplied(cells, dim, least, number), "rid long, links long, other long")
    found = stored(met, "links")
    edges = found.where("rid <> other").select(F.col("rid").alias("a"), F.col("other").alias("b"))
    links = found.select("rid", "links")
    balls = [(c, r["n"], r["rid"]) for c, r in stats.items() if c >= cells.n_cells]
    if balls:
        of_ball = F.broadcast(spark.createDataFrame(balls, "cell int, ball_n long, ball_rid long"))
        inside = placed.join(of_ball, "cell").select("rid", "ball_n", "ball_rid")
        edges = edges.unionByName(inside.where("rid <> ball_rid").select(F.col("rid").alias("a"), F.col("ball_rid").alias("b")))
        links = links.unionByName(inside.select("rid", (F.col("ball_n") - 1).alias("links")))
    comps = components(edges)
    each = vectors.select("rid", "vec_id").join(links.groupBy("rid").agg(F.sum("links").alias("links")), "rid", "left").join(comps.withColumnRenamed("node", "rid"), "rid", "left")
    each = stored(each.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("component", "rid").alias("component")), "figures")
    lowest = each.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    out = meet(each, lowest, "component").select("vec_id", "n_links", "component_id").unionByName(alone)
    drop_stored(vectors, placed, found)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
