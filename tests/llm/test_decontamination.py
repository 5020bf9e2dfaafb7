import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01
from helpers import awkward, empty
from mdmspark.llm import decontamination as dc


def brute_tile(doc, item, least):
    """Greedy string tiling by comparing every pair of places."""
    doc_free, item_free, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best = 0
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while (i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] >= 0 and doc_free[i + k] and item_free[j + k]):
                    k += 1
                best = max(best, k)
        if best < least:
            return tiles
        for j in range(len(item) - best + 1):
            for i in range(len(doc) - best + 1):
                if all(doc[i + k] == item[j + k] >= 0 and doc_free[i + k] and item_free[j + k] for k in range(best)):
                    tiles.append((i, j, best))
                    for k in range(best):
                        doc_free[i + k] = item_free[j + k] = False
                    break


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-1, 3), max_size=30), st.lists(st.integers(0, 3), min_size=1, max_size=15), st.integers(1, 4))
def test_tiles_equal_brute_force(doc, item, least):
    assert dc.tile(np.array(doc, np.int64), np.array(item, np.int64), least) == brute_tile(doc, item, least)


def fast_tile(doc, item, least):
    """The same tiling by run lengths of every pair of places, one turn of a
    table at a time: no hashes."""
    doc, item = np.array(doc), np.array(item)
    doc_free, item_free, tiles = doc >= 0, np.ones(len(item), bool), []
    while True:
        runs = np.zeros((len(doc) + 1, len(item) + 1), np.int32)  # common free run from (i, j) on
        for i in range(len(doc) - 1, -1, -1):
            runs[i, :-1] = np.where((doc[i] == item) & item_free & doc_free[i], runs[i + 1, 1:] + 1, 0)
        best = int(runs.max())
        if best < least:
            return tiles
        for j in np.flatnonzero((runs >= best).any(axis=0)):
            for i in np.flatnonzero(runs[:, j] >= best):
                if doc_free[i : i + best].all() and item_free[j : j + best].all():
                    tiles.append((int(i), int(j), best))
                    doc_free[i : i + best] = item_free[j : j + best] = False
                    break


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=500), st.lists(st.integers(0, 1), min_size=1, max_size=300), st.integers(2, 6))
def test_two_letters(doc, item, least):
    assert dc.tile(np.array(doc, np.int64), np.array(item, np.int64), least) == fast_tile(doc, item, least)


def thue_morse(n):
    return np.array([bin(i).count("1") & 1 for i in range(n)], np.int64)


def test_sequences_on_which_hashes_modulo_powers_of_two_agree():
    import time

    for n in (4096, 5000):
        text, item = thue_morse(n), 1 - thue_morse(n)
        began = time.time()
        got = dc.tile(text, item, 5)
        assert time.time() - began < 30
        assert got == fast_tile(text, item, 5), n


def test_any_collision_is_harmless(monkeypatch):
    # All hashes agree, so every decision rests on the ids themselves.
    monkeypatch.setattr(dc, "windows", lambda ids, size: np.zeros(max(0, len(ids) - size + 1), np.uint64))
    rng = random.Random(4)
    for _ in range(40):
        doc, item = [rng.randint(-1, 2) for _ in range(60)], [rng.randint(0, 2) for _ in range(30)]
        assert dc.tile(np.array(doc), np.array(item), 3) == fast_tile(doc, item, 3)


def test_one_word_repeated_takes_no_square_time():
    import time

    began = time.time()
    tiles = dc.tile(np.zeros(200_000, np.int64), np.zeros(3_000, np.int64), 5)
    assert tiles == [(0, 0, 3000)] and time.time() - began < 20
    began = time.time()
    dc.tile(np.array([0] * 9 + [-1], np.int64)[np.arange(100_000) % 10], np.zeros(4_000, np.int64), 5)
    assert time.time() - began < 30


@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_windows_are_equal_where_their_ids_are(ids, size):
    h = dc.windows(np.array(ids), size)
    assert len(h) == max(0, len(ids) - size + 1)
    for i in range(len(h)):
        for j in range(i):
            assert (h[i] == h[j]) == (ids[i : i + size] == ids[j : j + size])


def passages(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(20, 50)))) for k in range(12)]
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = []
    for d in range(60):
        k, text = items[d % 12]
        w = text.split()
        half = len(w) // 2
        docs.append((d, {0: f"{noise(30)} {text.upper()}. {noise(30)}", 1: f"{' '.join(w[half:])}, {noise(20)} {' '.join(w[:half])}",
                         2: f"{noise(40)} {' '.join(w[:7])} {noise(10)}", 3: noise(80), 4: text}[d // 12]))
    return items, docs


def test_whole_reordered_and_partial_passages(spark):
    items, docs = passages()
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = {(d, d % 12) for d in range(60) if d // 12 in (0, 1, 4)}
    for block_bytes in (1 << 20, 600):
        rows = dc.contaminated(table, bench, block_bytes=block_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == wanted
        assert all(r.n_covered == sum(t.length for t in r.tiles) and r.n_tiles == len(r.tiles) for r in rows)
        kept = dc.drop_contaminated(table, bench, block_bytes=block_bytes)
        assert {r.doc_id for r in kept.collect()} == set(range(60)) - {d for d, _ in wanted}


def test_documents_that_hold_an_item_are_found(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    rows = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, bench).collect()}
    items = bench.collect()
    assert {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in d.text} <= rows


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "Looked at the dog for a while"), (1, None), (2, ""), (3, "漢字"), (None, "looked at the dog for a while")], "item_id long, text string")
    rows = dc.contaminated(awkward(spark), bench).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in rows) == [(1, 0), (1, 0), (1, 1), (1, 1), (2, 0), (2, 1), (7, 3)]
    kept = dc.drop_contaminated(awkward(spark), bench)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 4, 5, 6, 8] and kept.columns == awkward(spark).columns
    none = bench.limit(0)
    assert dc.contaminated(awkward(spark), none).count() == 0 and dc.drop_contaminated(awkward(spark), none).count() == 11
    assert dc.contaminated(empty(spark), bench).count() == 0 and dc.drop_contaminated(empty(spark), bench).count() == 0
