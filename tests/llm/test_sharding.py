import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import awkward, empty
from mdmspark.llm import sharding
from mdmspark.llm.common import running_totals


def brute_capacity(sizes, n):
    low, high = max(max(sizes), -(-sum(sizes) // n)), sum(sizes)
    while low < high:
        mid, used, at = (low + high) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                used, at = used + 1, 0
            at += s
        low, high = (low, mid) if used <= n else (mid + 1, high)
    return low


def lookup(sizes, cells):
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]

    def look(stretches):
        width = max(1, sum(b - a for a, b in stretches) * 2 // cells)
        found = {}
        for a, b in stretches:
            for e in ends:
                if a < e <= b:
                    found.setdefault((a, (e - a - 1) // width), []).append(e)
        return [(min(v), max(v), len(v)) for v in found.values()]

    return look


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=120), st.integers(1, 12), st.sampled_from([2, 8, 64]))
def test_capacity_is_the_smallest_whatever_the_sketch(sizes, n, cells):
    capacity, known = sharding.smallest_capacity(sum(sizes), max(sizes), n, lookup(sizes, cells))
    assert capacity == brute_capacity(sizes, n)
    cuts = sharding.even_cuts(known, capacity, n)
    ends = {sum(sizes[: i + 1]) for i in range(len(sizes))} | {0}
    assert len(cuts) == n and cuts[-1] == sum(sizes) and set(cuts) <= ends
    assert all(0 <= b - a <= capacity for a, b in zip([0, *cuts], cuts))


def test_a_large_group_does_not_empty_the_other_shards():
    sizes = [3] * 50 + [100] + [3] * 50
    capacity, known = sharding.smallest_capacity(sum(sizes), 100, 10, lookup(sizes, 1 << 10))
    cuts = sharding.even_cuts(known, capacity, 10)
    parts = [b - a for a, b in zip([0, *cuts], cuts)]
    assert capacity == 100 and max(parts) == 100 and min(parts) > 0


@pytest.fixture
def small_sketch(monkeypatch):
    monkeypatch.setattr(sharding, "SKETCH", 16)


def test_shards_hold_groups_together_and_slots_are_gapless(spark, small_sketch):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 300), f"k{rng.randint(0, 90)}" if i % 3 else "hot") for i in range(700)]
    df = spark.createDataFrame(rows, "id long, size long, k string")
    out = sharding.minimax_shards(df, "size", F.col("k"), "id", 7).collect()
    assert len(out) == 700
    shard_of, slots, load = {}, {}, {}
    for r in out:
        assert shard_of.setdefault(r.k, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] = load.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for i, s, k in rows:
        first, total = groups.get(k, (i, 0))
        groups[k] = (min(first, i), total + s)
    assert max(load.values()) == brute_capacity([t for _, t in sorted(groups.values())], 7)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)) + 16)
    out = sharding.minimax_shards(rows.select("doc_id", "size", "text"), "size", F.coalesce("text", F.lit("")), "doc_id", 4).collect()
    assert len(out) == 11
    assert len({r.shard for r in out if r.text == "The cat sat on the mat and looked at the dog for a while."}) == 1
    assert sharding.minimax_shards(empty(spark).withColumn("size", F.lit(1)).select("doc_id", "size", "text"), "size", F.col("text"), "doc_id", 4).count() == 0


def test_running_totals_over_a_hot_key(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id", (F.col("id") % 7).alias("v"))
    out = running_totals(df, ["k", "id"], {"before": "v"}, "test-totals").collect()
    at = 0
    for r in sorted(out, key=lambda r: (r.k, r.id)):
        assert r.before == at
        at += r.v
