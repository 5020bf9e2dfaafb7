"""Centroid clustering (Lloyd's rounds) with ns-bounds.

For each vector and centroid a task keeps the exact distance at the round of
its last evaluation, and that round. The centroids of all rounds are retained,
so a bound is loosened by the norm of the centroid's total displacement since
then, which is never more than the sum of its drifts round by round. Only where
the loosened lower bound of a centroid does not lie above the upper bound of
the assigned one is the distance evaluated again, exactly.

Vectors are integers (``floor(scale * x)``), and every distance, sum and mean
is exact. Bounds are doubles with a margin above their rounding error, and only
a strictly greater bound rules a centroid out, so ties go to the smaller number.

Each round is one narrow pass that reads the table of the round before and
writes the next (vectors with their bounds, and one row per task and centroid
with the sums of the vectors that moved), and one aggregation of those few rows.
The round before the last is then deleted, so two are kept. The driver holds
centroids only: rounds x clusters x components.

Defined results: rows whose vector has another number of components, or a null
or non-finite one, are left out; a null id counts as an empty one for the choice
of first centroids; of equal hashes the smaller vector comes first; fewer rows
than clusters give as many clusters as rows; repeated rows are rows of their
own; an empty table gives an empty result. Components beyond 10 ** 24 count as
that, and a distance beyond a long as the largest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow
from mdmspark.session import discard_scratch, scratch_path

CLUSTERS, ROUNDS, SCALE, DIMENSIONS, SALT = 8, 10, 1024, 64, "3:"
# Up to this size of all components, distances are exact in doubles; beyond it they are Python integers.
NARROW = 1 << 22
WIDEST = 10**24
MOST = (1 << 63) - 1
# Margin of the bounds, relative; a double's error is some 1e-16.
MARGIN = 1e-9

_STATE = "near int, seen array<int>, dist array<double>"
_SUMS = "cluster int, n long, total array<decimal(38,0)>"


def usable(vector: str = "embedding", dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector has so many components, all of them finite."""
    finite = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``, as doubles where all are narrow, else as Python integers."""
    scaled = np.floor(x * float(scale)) if x.size else x
    with np.errstate(invalid="ignore"):
        if np.abs(scaled).max(initial=0) <= NARROW:
            return scaled
    exact = [int(v) * scale if abs(v) >= 2**53 else math.floor(v * scale) for v in x.ravel().tolist()]
    return np.array([max(-WIDEST, min(WIDEST, v)) for v in exact], object).reshape(x.shape)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x and c, as doubles or Python integers."""
    if x.dtype == object or c.dtype == object:
        gap = x.astype(object) - c.astype(object)
        return (gap * gap).sum(axis=-1)
    gap = x - c
    return np.einsum("ij,ij->i", gap, gap)


def _whole(values: np.ndarray) -> np.ndarray:
    """Doubles that are integers as Python integers."""
    return np.array([int(v) for v in values.ravel().tolist()], object).reshape(values.shape)


def mixed(centroids: list[list[int]]) -> np.ndarray:
    """Centroids as doubles where all are narrow, else as Python integers."""
    wide = any(abs(v) > NARROW for c in centroids for v in c)
    return np.array(centroids, object if wide else np.float64)


class Bounds:
    """What a task needs of a round: its centroids and how far each has moved since every round before."""

    def __init__(self, history: list[list[list[int]]]) -> None:
        self.round, self.now = len(history) - 1, mixed(history[-1])
        moved = [[math.sqrt(sum((a - b) ** 2 for a, b in zip(old, new))) for old, new in zip(then, history[-1])] for then in history]
        self.moved = np.array(moved, np.float64)

    def assign(self, x: np.ndarray, near: np.ndarray | None, seen: np.ndarray | None, dist: np.ndarray | None):
        """(near, seen, dist, evaluations) of the vectors ``x`` at this round;
        ``near`` is None where there are no bounds yet."""
        n, k = len(x), len(self.now)
        if near is None or x.dtype == object or self.now.dtype == object:
            every = np.stack([squared(x, self.now[j]) for j in range(k)], axis=1) if n else np.zeros((0, k))
            near = np.argmin(every, axis=1).astype(np.int32) if n else np.zeros(0, np.int32)
            if every.dtype == object:
                # Rounded down in bounds; wide rows are always evaluated anyway.
                every = np.array([[float(v) for v in row] for row in every]).reshape(n, k)
            return near, np.full((n, k), self.round, np.int32), every, n * k
        rows, each = np.arange(n), np.arange(k)
        near, seen, dist = near.copy(), seen.copy(), dist.copy()
        gone = self.moved[seen, each]
        root = np.sqrt(dist)
        lower = root * (1 - MARGIN) - gone * (1 + MARGIN)
        lower[rows, near] = np.inf
        upper = (root[rows, near] + gone[rows, near]) * (1 + MARGIN)
        done = 0
        doubtful = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
        if len(doubtful):
            # First the assigned centroid: an exact upper bound settles most.
            own = near[doubtful]
            dist[doubtful, own], seen[doubtful, own] = squared(x[doubtful], self.now[own]), self.round
            upper = np.sqrt(dist[doubtful, own]) * (1 + MARGIN)
            failed = lower[doubtful] <= upper[:, None]
            done = len(doubtful)
            for j in np.flatnonzero(failed.any(axis=0)):
                at = doubtful[failed[:, j]]
                dist[at, j], seen[at, j] = squared(x[at], self.now[j]), self.round
                done += len(at)
            failed[np.arange(len(doubtful)), own] = True
            near[doubtful] = np.argmin(np.where(failed, dist[doubtful], np.inf), axis=1)
        return near, seen, dist, done

    def final(self, x: np.ndarray, near: np.ndarray) -> list[int]:
        """Exact distances to the assigned centroids."""
        return [min(MOST, int(d)) for d in (squared(x, self.now[near]) if len(x) else [])]


def _matrix(b: pa.RecordBatch, name: str, width: int, kind) -> np.ndarray:
    return b.column(name).flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(b.num_rows, width)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1], pa.int32()), pa.array(m.ravel(), kind))


def _split(x: np.ndarray, scale: int) -> list[np.ndarray]:
    """Row numbers of the narrow rows and of the others."""
    wide = np.abs(x).max(axis=1, initial=0) * float(scale) > NARROW
    return [part for part in (np.flatnonzero(~wide), np.flatnonzero(wide)) if len(part)]


def step(table: DataFrame, history: list, first: bool, scale: int, key: str, vector: str) -> DataFrame:
    """The next table: every row with its bounds, and each task's sums of the rows that moved."""
    k, size = len(history[0]), len(history[0][0])
    schema = f"vec_id {key}, embedding {vector}, {_STATE}, {_SUMS}"
    names = ["vec_id", "embedding", "near", "seen", "dist", "cluster", "n", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(history)
        count, total = np.zeros(k, np.int64), np.zeros((k, size), object)
        ids = x_kind = None
        for b in batches:
            ids, x_kind = b.schema.field("vec_id").type, b.schema.field("embedding").type
            if not b.num_rows:
                continue
            raw = _matrix(b, "embedding", size, np.float64)
            near, seen, dist = np.zeros(b.num_rows, np.int32), np.zeros((b.num_rows, k), np.int32), np.zeros((b.num_rows, k))
            old = None if first else (b.column("near").to_numpy(), _matrix(b, "seen", k, np.int32), _matrix(b, "dist", k, np.float64))
            for rows in _split(raw, scale):
                x = integers(raw[rows], scale)
                before = (None, None, None) if first else tuple(o[rows] for o in old)
                near[rows], seen[rows], dist[rows], _ = bounds.assign(x, *before)
                for sign, where in ((1, near[rows]), (-1, before[0])):
                    if where is None:
                        continue
                    moved = np.ones(len(rows), bool) if first else near[rows] != before[0]
                    for j in np.unique(where[moved]):
                        part = x[moved & (where == j)]
                        count[j] += sign * len(part)
                        total[j] += sign * (part.sum(axis=0) if part.dtype == object else _whole(part.sum(axis=0)))
            none = [pa.nulls(b.num_rows, t) for t in (pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(near), _lists(seen, pa.int32()), _lists(dist, pa.float64()), *none], names=names)
        touched = [j for j in range(k) if count[j] or any(total[j])]
        if touched:
            sums = pa.array([[Decimal(int(v)) for v in total[j]] for j in touched], pa.list_(pa.decimal128(38, 0)))
            none = [pa.nulls(len(touched), t) for t in (ids, x_kind, pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array(touched, pa.int32()), pa.array(count[touched]), sums], names=names)

    return map_arrow(table, run, schema)


def _next(centroids: list[list[int]], counts: list[int], totals: list[list[int]]) -> list[list[int]]:
    return [[t // n for t in total] if n else c for c, n, total in zip(centroids, counts, totals)]


def cluster(vectors: DataFrame, *, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dimensions: int = DIMENSIONS, salt: str = SALT) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and
    ``centroid`` (the components of the cluster's last centroid) of every usable
    row of ``vectors`` (vec_id, embedding), after so many rounds.

    The first centroids are the rows with the smallest sha256 of ``salt`` and id."""
    spark = vectors.sparkSession
    kept = vectors.where(usable("embedding", dimensions)).select("vec_id", "embedding")
    key, vector = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "embedding"))
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = kept.select(hashed.alias("h"), "embedding").orderBy("h", "embedding").limit(clusters).collect()
    if not seeds:
        return spark.createDataFrame([], f"vec_id {key}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<decimal(38,0)>")
    history = [[[int(v) for v in integers(np.array([r.embedding], np.float64), scale)[0]] for r in seeds]]
    counts, totals = [0] * len(seeds), [[0] * dimensions for _ in seeds]
    state, paths = kept, []
    for _ in range(rounds):
        path = scratch_path(spark, "ns-round")
        step(state, history, not paths, scale, key, vector).write.parquet(path)
        table = spark.read.schema(f"vec_id {key}, embedding {vector}, {_STATE}, {_SUMS}").parquet(path)
        # One row per task and touched cluster; at most clusters x components come back.
        moved = table.where("cluster is not null").select("cluster", "n", F.posexplode("total").alias("i", "t"))
        for r in moved.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect():
            totals[r.cluster][r.i] += int(r.t)
            if r.i == 0:
                counts[r.cluster] += r.n
        if paths:
            discard_scratch(spark, paths[-1])
        paths.append(path)
        state = table.where("cluster is null").select("vec_id", "embedding", "near", "seen", "dist")
        history.append(_next(history[-1], counts, totals))
        if history[-1] == history[-2]:
            break  # no centroid moved: all rounds that are left would repeat this one
    first = not paths

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(history)
        k, size = len(history[0]), len(history[0][0])
        for b in batches:
            raw = _matrix(b, "embedding", size, np.float64)
            near, far = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows, np.int64)
            for rows in _split(raw, scale):
                x = integers(raw[rows], scale)
                before = (None, None, None) if first else (b.column("near").to_numpy()[rows], _matrix(b, "seen", k, np.int32)[rows], _matrix(b, "dist", k, np.float64)[rows])
                near[rows] = bounds.assign(x, *before)[0]
                far[rows] = bounds.final(x, near[rows])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(near), pa.array(far)], names=["vec_id", "cluster", "distance"])

    path = scratch_path(spark, "ns-clusters")
    map_arrow(state, last, f"vec_id {key}, cluster int, distance long").write.parquet(path)
    if paths:
        discard_scratch(spark, paths[-1])
    out = spark.read.schema(f"vec_id {key}, cluster int, distance long").parquet(path)
    found = {r.cluster: int(r.d) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole = min(MOST, sum(found.values()))
    rows = [(j, min(MOST, d), whole, [Decimal(v) for v in history[-1][j]]) for j, d in sorted(found.items())]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<decimal(38,0)>")
    # One row per cluster.
    return out.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
