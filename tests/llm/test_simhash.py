import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01
from helpers import awkward, empty
from mdmspark.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance=2):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


@given(st.text(alphabet=st.sampled_from("abcAZé \n\t\x0b\x1c  "), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(simhash.shingle_hashes(text)) == brute_fingerprint(text)


def test_gray_rank_orders_the_gray_codes():
    i = np.arange(1024, dtype=np.uint64)
    assert (simhash.gray_rank(i ^ (i >> np.uint64(1))) == i).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 300), st.integers(1, 3))
def test_forest_has_the_components_of_all_links(seed, n, centres):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(centres)]
    codes = sorted({rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(n)})
    u, v = simhash.forest(np.array(codes, np.uint64))
    assert len(u) < len(codes) and all((int(a) ^ int(b)) is not None for a, b in zip(u, v))
    expected, root = brute_components(codes), {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in zip(u.tolist(), v.tolist()):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert {c: find(c) for c in codes} == expected


def test_split_masks_cover_all_bits_once():
    for mask in (0, (1 << 22) - 1, (1 << 60) - 1, (1 << 63) | 1):
        parts = [m & ~mask for m in simhash.split_masks(mask)]
        assert sum(parts) == (1 << 64) - 1 - mask and all(m & mask == mask for m in simhash.split_masks(mask))


def crowd(spark, n=600):
    """A crowd of codes around one centre, others, and copies."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    codes = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(n)] + [rng.getrandbits(64) for _ in range(n)]
    codes += [c ^ 1 for c in codes[-n // 4 :]] + codes[:50]
    return codes, spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in sorted(set(codes))], "fp long")


def test_nodes_of_any_size_give_the_same_components(spark):
    codes, fps = crowd(spark)
    expected = brute_components(sorted(set(codes)))
    for most in (40, 100_000):
        nodes = simhash.upper_nodes(fps, 2, most)
        assert max(r["count"] for r in nodes.groupBy("mask", "pattern").count().collect()) <= most
        found = {r.node % (1 << 64): r.component % (1 << 64) for r in simhash.components(simhash.node_edges(nodes, 2)).collect()}
        groups, wanted = {}, {}
        for c in expected:
            groups.setdefault(found.get(c, c), set()).add(c)
            wanted.setdefault(expected[c], set()).add(c)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = simhash.near_duplicates(docs).collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    assert {r.doc_id: r.fp % (1 << 64) for r in rows} == prints and len(rows) == len(prints)
    parts, first = brute_components(sorted(set(prints.values()))), {}
    for d, fp in sorted(prints.items()):
        first.setdefault(parts[fp], d)
    assert {r.doc_id: r.component_id for r in rows} == {d: first[parts[fp]] for d, fp in prints.items()}
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} == set(first.values())


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "u long, v long")
    found = {r.node: r.component for r in simhash.components(edges).collect()}
    assert {found[i] for i in range(201)} == {0} and found[1001] == 1000


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert len(rows) == 11 and by[1][0] == by[1][1] == by[2][0] and by[1][0][1] == 1
    assert by[3] == by[4] == by[5] == [(0, 3)]
    kept = simhash.keep_first(awkward(spark))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8] and kept.columns == awkward(spark).columns
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_first(empty(spark)).count() == 0


def test_components_that_are_not_settled_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    with pytest.raises(RuntimeError, match="not settled"):
        simhash.components(edges, rounds=1)
    assert {r.component for r in simhash.components(edges).collect()} == {0}


def test_copies_with_equal_or_no_ids_are_copies(spark, tmp_root):
    text, other = "one two three four five six seven eight nine ten", "quite another text about other things that nobody copied at all"
    rows = [(None, text), (None, text), (5, text), (5, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert [(r.doc_id, r.text) for r in simhash.keep_first(df).collect()] == [(5, text)]
    two = spark.createDataFrame([*rows, (None, other), (None, other), (5, other + " x y z w q")], "doc_id long, text string").repartition(4)
    two.write.parquet(tmp_root)
    kept = simhash.keep_first(spark.read.parquet(tmp_root))
    assert kept.columns == ["doc_id", "text"]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(5, text), (0, other), (5, other + " x y z w q")])


def test_a_near_copy_whose_id_stands_on_a_kept_row_goes(spark):
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"v{i}" for i in range(400))
    df = spark.createDataFrame([(1, a), (2, b), (1, b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text[0]) for r in simhash.keep_first(df).collect()) == [(1, "v"), (1, "w")]


def test_a_hub_is_split_over_tasks(spark):
    """A star of 100,000: the join on its centre, shaped as in ``components``
    (a written side, so that there are plain exchanges only), is split by Spark;
    with the aggregate itself as that side it isn't."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        star = spark.range(1, 100_001).select(F.col("id").alias("u"), F.lit(0).cast("long").alias("v"))
        found = simhash.components(star, "hub")
        assert found.count() == 100_001 and found.where("component != 0").count() == 0
        both = simhash.materialize(star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both").repartition(8)
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        split = []
        for side in (least, simhash.materialize(least, "least")):
            joined = both.where("v > u").join(side, "u")
            joined.collect()
            split.append("skew=true" in joined._jdf.queryExecution().executedPlan().toString())
        assert split == [False, True]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
