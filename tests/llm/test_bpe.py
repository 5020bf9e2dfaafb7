"""Byte-level BPE against the tokenizer's own library and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from conftest import SF001
from helpers import awkward, empty
from mdmspark.llm import bpe
from mdmspark.llm.queries import op11_bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


PARTS = ["a", "aa", "ab", "=", "-", "0", "1", "the", "ing", "ation", "é", "漢", "\U0001f642", "ß", "x", "\n", " ", "  ", " ", "'s", "'", ".", "́"]


def texts(n, seed=3):
    rng = random.Random(seed)
    for i in range(n):
        some = rng.sample(PARTS, rng.choice([1, 2, 4, len(PARTS)]))
        yield "".join(rng.choice(some) for _ in range(rng.choice([0, 3, 20, 90, 400])))


def test_texts_equal_the_library(encoder, library):
    for t in texts(3000):
        packed = encoder.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(t), t
        assert encoder.decode(packed) == t.encode()


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_the_tree_equals_plain_merging_at_any_leaf(encoder, monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF", leaf)
    for t in texts(600, leaf):
        piece = t.replace(" ", "").encode()
        assert encoder.reduce(piece) == encoder.merge(piece) if piece else True


def test_any_cut_joins_to_the_same_ids(encoder):
    for piece in (b"a" * 75, b"antidisestablishmentarianism" * 3, b"=-" * 40, "漢字é".encode() * 9):
        whole = encoder.merge(piece)
        for cut in range(1, len(piece)):
            assert encoder.join(encoder.merge(piece[:cut]), encoder.merge(piece[cut:])) == whole


def test_heap_and_list_merge_alike(encoder, monkeypatch):
    pieces = [t.encode() for t in texts(400, 8) if t]
    plain = []
    monkeypatch.setattr(bpe, "HEAP", 1 << 30)
    plain = [encoder.merge(p) for p in pieces]
    assert [encoder._merge_by_heap(p) for p in pieces] == plain


def test_a_ranking_whose_merges_reach_far(tmp_path):
    # In a file of odd ranks a later byte can change merges far to the left.
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"aa", b"aaaa", b"ba", b"aaab", b"aaaaaaaa", b"ab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    e = bpe.Encoder(str(path), PATTERN)
    own = tiktoken.Encoding("far", pat_str=PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    rng = random.Random(5)
    for _ in range(500):
        t = "".join(rng.choice("aaaab") for _ in range(rng.randint(1, 200)))
        assert np.frombuffer(e.encode(t), "<u4").tolist() == own.encode_ordinary(t)


def test_stretches_cut_where_matches_end(encoder):
    for t in texts(300, 11):
        parts = list(bpe.stretches(t, 7))
        assert "".join(parts) == t
        assert [m for p in parts for m in encoder.pattern.findall(p)] == encoder.pattern.findall(t)


def test_memory_is_bounded():
    small = bpe.Encoder(RANKS, PATTERN, memory=50)
    for i in range(40):
        small.encode(" ".join(f"word{i}x{k}" for k in range(30)))
        assert len(small) < 250 and len(small.old) < 250
    long = "x" * 5000
    small.encode(long)
    assert long not in small


def test_a_file_without_a_byte_is_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        bpe.Encoder(str(path), PATTERN)


def test_awkward_rows(spark, library):
    docs = awkward(spark).withColumns({"ids": F.lit("x"), "n_tokens": F.lit(1), "decoded": F.lit(2)})
    rows = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    wanted = sorted((r.doc_id or 0, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    assert sorted((r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in rows) == wanted
    assert all(r.n_tokens * 4 == len(r.ids) for r in rows)
    assert bpe.decode(bpe.encode(empty(spark), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_ids_that_are_no_tokens_decode_to_null(spark):
    rows = [(1, np.array([0, 70_000], "<u4").tobytes()), (2, b"\x01\x00"), (3, None), (4, b""), (5, np.array([64, 65], "<u4").tobytes())]
    got = {r.doc_id: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), RANKS, PATTERN).collect()}
    assert got[1] is None and got[2] is None and got[3] is None and bytes(got[4]) == b"" and bytes(got[5]) == b"ab"


def test_query_equals_the_library(spark, library):
    texts_of = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in op11_bpe(spark, SF001).collect():
        ids, text = library.encode_ordinary(texts_of[r.doc_id] or ""), (texts_of[r.doc_id] or "").encode()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest())
