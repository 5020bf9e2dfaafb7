import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from helpers import ROWS, awkward, empty
from mdmspark.llm import packing
from mdmspark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def ids():
    return packing.WordIds(tokenizer_path(), memory=50)


def whole(ids, text):
    return np.array(ids.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


ALPHABET = st.sampled_from(list("abCDé ü\n\t.,!'’-_*12²ΣσςİıßǅÅ漢🙂́  \x1c|<>") + ["<|endoftext|>", "'s", "'RE", "the ", "n't "])


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_word_by_word_ids_equal_whole_text_ids(ids, text):
    assert ids.encode(text) == whole(ids, text)


def test_ids_of_documents(spark, ids):
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        assert ids.encode(r.text) == whole(ids, r.text)
    assert len(ids) + len(ids.old) < 20_000


@given(st.integers(0, 50_000), st.integers(1, 12).map(lambda b: 1 << b))
def test_piece_lengths(n, most):
    parts = packing.piece_lengths(n, most)
    assert sum(parts) == n and all(p <= most and p & (p - 1) == 0 for p in parts)
    rest = [p for p in parts if p < most]
    assert len(set(rest)) == len(rest) and parts == sorted(parts, reverse=True)


def test_pieces_are_a_round_trip(spark, ids):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    texts, by_doc = {r.doc_id: r.text for r in docs.collect()}, {}
    for r in rows:
        raw = np.array(r.ids, "<u4").tobytes()
        assert len(r.ids) == r.length and zlib.crc32(raw) == r.ids_crc32 and r.offset == 0
        by_doc.setdefault(r.doc_id, []).append((r.start, raw, r.doc_tokens))
    for d, text in texts.items():
        parts = sorted(by_doc[d])
        raw = b"".join(p for _, p, _ in parts)
        assert raw == whole(ids, text) + np.array([packing.END_ID], "<u4").tobytes()
        assert {n for *_, n in parts} == {len(raw) // 4}
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    buckets = {}
    for r in rows:
        buckets.setdefault(r.length, []).append((r.bucket_index, r.sequence_id))
    for b in buckets.values():
        assert [i for i, _ in sorted(b)] == list(range(len(b)))
        assert max(s for _, s in b) - min(s for _, s in b) == len(b) - 1


def test_awkward_rows(spark):
    rows = packing.pack(awkward(spark), tokenizer_path()).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert [(r.length, r.doc_tokens) for r in rows if r.doc_id in (3, 4, 5)] == [(1, 1)] * 3
    assert sum(r.length for r in rows if r.doc_id == 6) == [r.doc_tokens for r in rows if r.doc_id == 6][0] > 100_000
    assert len([r for r in rows if r.doc_id == 1]) == 2 * len([r for r in rows if r.doc_id == 2])
    assert len(ROWS) == 11
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0
