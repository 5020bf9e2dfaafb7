"""Language identification with error-correcting output codes.

Every language gets a codeword; one binary classifier per bit, over hashed
character n-grams, predicts that bit; the language whose codeword has the
smallest loss, weighted by how well each bit's classifier does in training, is
chosen. A small lead over the next codeword flags ambiguity.

* Codewords are rows of a Sylvester-Hadamard matrix of twice as many columns as
  languages (rounded up to a power of two): any two differ in half of the bits.
* A bit's classifier is linear: the weight of an n-gram is the log ratio of its
  mean share in the languages with that bit on and in those with it off.
  Shares come from counts over all training rows, summed map-side and merged by
  a shuffle; the model has languages x ``BUCKETS`` numbers, however much text
  there is. Of a ``lang`` column with more than ``LANGUAGES`` different values
  (a dirty one) those with the most training rows are learnt. The margin is the mean weight over the text's n-grams, scaled per
  bit to the training margins, so short and long texts compare.

Only texts and languages of training rows are learnt from. Defined results: a
null text or one without a letter is ``und`` with score 0, as is every text if
there is nothing to learn from; ties go to the language that sorts first;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow, slices

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
# Languages that are learnt at most: those with the most rows, of equals the ones that sort first.
LANGUAGES = 256
ORDERS = (1, 2, 3, 4)
# A lead of less than this over the next language, as a share of the losses, is ambiguous.
AMBIGUOUS = 0.05
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


@cache
def _in_words() -> np.ndarray:
    """For every code point whether it is a letter or a mark."""
    table = np.zeros(0x110000, bool)
    table[[m.start() for m in regex.finditer(r"[\p{L}\p{M}]", "".join(map(chr, range(len(table)))))]] = True
    return table


def spaced_words(text: str) -> bytes:
    """The text in lower case with one space for every run of other characters
    than letters and marks, between spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = _in_words()[points]
    kept = inside.copy()
    kept[:1] = True
    kept[1:] |= inside[:-1]  # the first of a run of others
    words = np.where(inside, points, np.uint32(32))[kept].tobytes().decode("utf-32-le", "surrogatepass")
    return f" {words} ".encode("utf-8", "surrogatepass")


def features(text: str) -> np.ndarray:
    """Hashed byte n-grams of the text's words (letters only, in lower case, one space between)."""
    raw = np.frombuffer(spaced_words(text), np.uint8).astype(np.uint32)
    out, at, gram = np.empty(sum(max(0, len(raw) + 1 - n) for n in ORDERS), np.int64), 0, raw
    for n in range(1, min(max(ORDERS), len(raw)) + 1):
        if n > 1:
            gram = gram[:-1] << np.uint32(8)
            gram |= raw[n - 1 :]
        if n in ORDERS:
            mixed = gram ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)
            mixed *= np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0xC2B2AE35)
            mixed >>= np.uint32(32 - BUCKET_BITS)
            out[at : at + len(mixed)] = mixed
            at += len(mixed)
    return out


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: rows of a Hadamard matrix without its constant column."""
    h = np.ones((1, 1), np.int8)
    while len(h) < max(4, 2 * n):
        h = np.block([[h, h], [h, -h]])
    return h[1 : n + 1, 1:].astype(float)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray  # typical size of a bit's margin in training
    trust: np.ndarray  # weight of a bit's loss

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, ambiguous)."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = np.clip(self.margins(features(text)) / self.scale, -30, 30)
        loss = (np.log1p(np.exp(-self.codes * margin)) * self.trust).sum(axis=1)
        best = np.argsort(loss, kind="stable")[:2]
        share = np.exp(loss[best[0]] - loss).sum()
        lead = (loss[best[1]] - loss[best[0]]) / max(loss[best[1]], 1e-12)
        return self.languages[best[0]], float(1 / share), bool(lead < AMBIGUOUS)

    def margins(self, found: np.ndarray) -> np.ndarray:
        """Mean weight of the n-grams for each bit; a text of few of them reads their rows only."""
        if 4 * len(found) < BUCKETS:
            return np.ones(len(found)) @ np.take(self.weights, found, axis=0) / max(1, len(found))
        return np.bincount(found, minlength=BUCKETS) @ self.weights / len(found)


def count_features(train: DataFrame) -> DataFrame:
    """(lang, bucket, n) over all rows of ``train`` (text, lang); each task sends one row per language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in slices(batches):
            found: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                found.setdefault(lang, []).append(features(text))
            for lang, grams in found.items():  # a slice's texts of a language at once
                n = np.bincount(np.concatenate(grams), minlength=BUCKETS)
                totals[lang] = totals[lang] + n if lang in totals else n
        for lang, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])

    return map_arrow(train.select("text", "lang"), run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(train: DataFrame, most: int = LANGUAGES) -> Model:
    """The model of ``train`` (text, lang), of at most so many languages; rows without a text or language teach nothing."""
    usable = train.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    frequent = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most + 1).collect()
    if len(frequent) > most:
        usable = usable.where(F.col("lang").isin([r.lang for r in frequent[:most]]))
    rows = count_features(usable).toArrow()  # languages x buckets at most
    named = rows.column("lang").combine_chunks().dictionary_encode() if rows.num_rows else pa.array([], pa.string()).dictionary_encode()
    languages = sorted(named.dictionary.to_pylist())
    place = np.array([languages.index(x) for x in named.dictionary.to_pylist()], np.int64)
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        counts[place[named.indices.to_numpy()], rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((BUCKETS, 0)), np.ones(0), np.ones(0))
    share = (counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)
    codes = codewords(len(languages))
    on = codes > 0
    use = on.any(axis=0) & (~on).any(axis=0)  # a bit that all languages share tells nothing
    codes, on = codes[:, use], on[:, use]
    weights = np.log((share.T @ on) / on.sum(axis=0)) - np.log((share.T @ ~on) / (~on).sum(axis=0)) if len(languages) > 1 else np.zeros((BUCKETS, 0))
    # Mean margin of each language's own text on each bit: how far, and on which side.
    own = (counts / np.maximum(1, counts.sum(axis=1, keepdims=True))) @ weights * codes
    scale = np.maximum(np.abs(own).mean(axis=0), 1e-6) / 4
    trust = np.clip(own.min(axis=0) / np.maximum(np.abs(own).mean(axis=0), 1e-6), 0.1, 1.0)
    return Model(languages, codes, weights, scale, trust)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ``ambiguous`` of every row of ``docs`` (doc_id, text). Narrow."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, score, doubt = zip(*map(shared.value.predict, b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(doubt)],
                                             names=["doc_id", "lang_pred", "score", "ambiguous"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {key}, lang_pred string, score double, ambiguous boolean")
