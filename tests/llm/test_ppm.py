import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF001
from helpers import awkward, empty
from mdmspark.llm import ppm
from mdmspark.llm.queries import op4_ppm


def norm(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


class Brute:
    """The same model by dictionaries, one symbol at a time."""

    def __init__(self, texts, order, share):
        self.order, self.counts = order, defaultdict(Counter)
        n = 0
        for t in texts:
            raw = bytes([ppm.START]) * order + " ".join(norm(t)).encode() + bytes([ppm.END])
            for i in range(order, len(raw)):
                n += 1
                for k in range(order + 1):
                    self.counts[raw[i - k : i]][raw[i]] += 1
        self.least = max(1.0, share * n)

    def log10(self, context, symbol):
        score, out = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.counts.get(context[len(context) - k :], {})
            kept = {s: n for s, n in seen.items() if n >= self.least}
            if not kept:
                continue
            free = {s: n for s, n in kept.items() if s not in out}
            escape = len(free) + sum(n for s, n in seen.items() if s not in kept)
            total = sum(free.values()) + escape
            if symbol in free:
                return score + math.log10(free[symbol] / total)
            if total:
                score += math.log10(escape / total)
            out = set(kept)
        return score - math.log10(ppm.SYMBOLS - len(out))

    def score(self, text):
        raw = bytes([ppm.START]) * self.order + " ".join(norm(text)).encode() + bytes([ppm.END])
        return sum(self.log10(raw[i - self.order : i], raw[i]) for i in range(self.order, len(raw)))


@pytest.mark.parametrize("order,share", [(3, 0.0), (2, 0.002), (5, 0.0005)])
def test_scores_equal_brute_force(spark, order, share):
    texts = [r.text[:300] for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()]
    train = spark.createDataFrame([(t,) for t in texts[:30]], "text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    brute = Brute(texts[:30], order, share)
    for r in ppm.score_documents(docs, train, order=order, share=share).collect():
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]), rel=1e-9)


@pytest.mark.parametrize("gram_share", [0.0, ppm.GRAM_SHARE, 2.0])
def test_every_entry_counts_at_any_size(spark, gram_share):
    # More than 500,000 symbols: an entry seen once is below 2e-6 of them.
    texts = ["to be or not to be " * 40_000, "a quick zebra jumps", "some quick zebras jumped over", "völlig neu"]
    train = spark.createDataFrame([(t,) for t in texts[:3]], "text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    brute = Brute(texts[:3], ppm.ORDER, 0.0)
    got = {r.doc_id: r.score for r in ppm.score_documents(docs, train, gram_share=gram_share).collect()}
    for i in (1, 2, 3):
        assert got[i] == pytest.approx(brute.score(texts[i]), rel=1e-9)


def test_chances_sum_to_one(spark):
    texts = spark.read.parquet(f"{SF001}/documents.parquet").select("text")
    trie = ppm.fit(texts, order=4, share=1e-4)
    every = np.array([b for b in range(256) if b != ppm.START], np.uint64)
    for context in (b"the ", b"\xfe\xfe\xfe\xfe", b"zzzz", b" th\xc3", b"qq t"):
        packed = np.uint64(int.from_bytes(context, "big") << 8) | every
        assert (10 ** trie.log10(packed)).sum() == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize("head_share", [0.0, 0.01, 2.0])
def test_base_equals_brute_force(spark, head_share):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {d for d in texts if zlib.crc32(str(d).encode()) % 5 == 1}
    count = Counter(w for d, t in texts.items() if d not in held for w in [*norm(t), ""])
    n, v = sum(count.values()), len(count)
    train = docs.where(~docs.doc_id.isin(*held))
    for r in ppm.score_documents(docs, train, order=2, head_share=head_share).collect():
        words = [*norm(texts[r.doc_id]), ""]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words), rel=1e-9)


def test_query_holds_out_by_checksum(spark):
    for r in op4_ppm(spark, SF001).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score < 0 and r.base_score < 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = ppm.score_documents(docs, docs).collect()
    assert len(rows) == 11 and len({(r.n_tokens, r.score, r.base_score) for r in rows if r.doc_id in (1, 2)}) == 1
    assert len({(r.n_tokens, r.n_known, r.score) for r in rows if r.doc_id in (3, 4, 5)}) == 1
    none = ppm.score_documents(docs, empty(spark)).collect()
    assert {r.n_known for r in none} == {0} and {r.train_tokens for r in none} == {0}
    end = [r.score for r in none if r.doc_id == 3]
    assert end == [pytest.approx(-math.log10(ppm.SYMBOLS))]
    assert ppm.score_documents(empty(spark), docs).count() == 0
