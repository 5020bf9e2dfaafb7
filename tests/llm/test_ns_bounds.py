"""Rounds with ns-bounds against rounds that evaluate every distance."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mdmspark.llm import ns_bounds as ns
from mdmspark.session import _SCRATCH

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, dims, clusters=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v], v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2]))[:clusters]
    centroids = [c for _, c, _ in first]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(centroids)), key=lambda j: (away(v, centroids[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(near(v), []).append(v)
        centroids = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else old for j, old in enumerate(centroids)]
    found = [(i, near(v), away(v, centroids[near(v)])) for i, v, _ in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for _, j, _ in found}
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), tuple(centroids[j])) for i, j, d in found), key=repr)


def clustered(spark, rows, dims, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("near", "seen", "dist", "cluster", "n", "total", "h", "label")})
    got = ns.cluster(df, dimensions=dims, **options).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(int(c) for c in r.centroid)) for r in got), key=repr)


def random_rows(n, dims, seed):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.5) for _ in range(dims)] for _ in range(9)]
    return [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(base)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = random_rows(250, 5, seed)
    assert clustered(spark, rows, 5) == brute(rows, 5)


def test_ties_and_copies(spark):
    rng = random.Random(4)
    rows = [(i, [0.5, 0.5] if i % 3 == 0 else [rng.choice([0.0, 0.25, 0.5]) for _ in range(2)]) for i in range(200)] + [(7, [0.25, 0.0])] * 5
    assert clustered(spark, rows, 2) == brute(rows, 2)


def test_awkward_rows(spark):
    rows = random_rows(30, 3, 5) + [(None, [0.1, 0.2, 0.3]), (None, [0.3, 0.2, 0.1]), (3, None), (4, []), (5, [1.0]), (6, [1.0] * 4), (8, [None, 1.0, 1.0]),
                                    (9, [math.nan, 0.0, 0.0]), (11, [0.0, math.inf, 0.0]), (12, [0.0, 0.0, -math.inf])]
    assert clustered(spark, rows, 3) == brute(rows, 3)
    few = random_rows(5, 3, 6)
    assert clustered(spark, few, 3) == brute(few, 3)
    assert clustered(spark, few, 3, rounds=0) == brute(few, 3, rounds=0)
    assert ns.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ns.cluster(spark.createDataFrame([(1, None), (2, [0.5])], SCHEMA)).count() == 0


def test_wide_components_are_exact(spark):
    rows = random_rows(40, 3, 7) + [(100 + i, [5e4 * i, -2e5, 0.5 * i]) for i in range(10)]
    assert clustered(spark, rows, 3) == brute(rows, 3)


def test_distances_and_components_beyond_their_types(spark):
    rows = random_rows(12, 2, 8) + [(50, [1e300, 0.0]), (51, [-1e30, 4.0])]
    got = clustered(spark, rows, 2, clusters=2, rounds=2)
    assert len(got) == 14 and max(r[2] for r in got) <= ns.MOST


def test_bounds_rule_out_most_distances_and_never_a_nearest_one():
    rng = np.random.default_rng(9)
    x = ns.integers(np.concatenate([rng.normal(c, 0.05, (500, 6)) for c in range(8)]))
    history = [[[int(v) for v in row] for row in x[rng.choice(len(x), 8, replace=False)]]]
    state, work = (None, None, None), []
    for _ in range(12):
        *state, done = ns.Bounds(history).assign(x, *state)
        work.append(done)
        every = np.stack([ns.squared(x, np.array(c, float)) for c in history[-1]], axis=1)
        assert (state[0] == every.argmin(axis=1)).all()
        counts = np.bincount(state[0], minlength=8)
        history.append([[int(v) for v in x[state[0] == j].sum(axis=0) // counts[j]] if counts[j] else history[-1][j] for j in range(8)])
    assert sum(work[1:]) < 0.5 * 11 * work[0]


def test_total_displacement_is_less_than_the_drifts():
    # A centroid that comes back has not moved, however far it went.
    bounds = ns.Bounds([[[0, 0], [9, 9]], [[100, 0], [9, 9]], [[0, 0], [9, 9]]])
    assert bounds.moved[0].tolist() == [0, 0] and bounds.moved[1].tolist() == [100, 0]


def test_two_rounds_are_kept(spark):
    before = len(_SCRATCH.get(spark.sparkContext.applicationId, []))
    clustered(spark, random_rows(100, 4, 10), 4)
    assert len(_SCRATCH[spark.sparkContext.applicationId]) == before + 1  # the assignment only
