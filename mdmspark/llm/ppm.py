"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes. A byte is coded
under its longest known context; if it was not seen there, an escape is coded
(its chance follows from the number of distinct successors, method C) and the
next shorter context is tried, without the symbols that the longer one has
already ruled out (exclusion); at last all bytes are alike. A document's score
is the sum of the log10 probabilities of its bytes and of an end symbol.

Text is read as words `[^\\x20\\x09-\\x0D]+`, A-Z in lower case, joined by single
spaces. The model is pretrained: (context, byte) counts are gathered from every
training document, summed in each task and then by a shuffle. Every entry is
kept, in tables written for each length of context, so the model grows with the
corpus and no entry needs to fit anywhere. (``share`` leaves out entries below
that share of all counted bytes; what is left out adds to the escape of its
context, so probabilities still sum to one.)

A document's grams are scored in two ways that give the same numbers. Frequent
ones (at least ``GRAM_SHARE`` of all counted bytes, hence at most
``1 / GRAM_SHARE`` of them) are looked up in each task. All others are scored
once each by joins with the tables, level by level, and joined back by key.

The unigram base counts whole words. Frequent words (at least ``HEAD_SHARE`` of
all tokens, hence at most ``1 / HEAD_SHARE`` of them) are looked up in each
task; all others are joined by key, so neither the vocabulary nor a hot word
gathers in one place, and every count is exact.

Defined results: a null or empty text is its end alone; repeated rows are
scored one by one; with no training row all bytes are alike and a known word
does not exist; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow, materialize, slices

ORDER = 5
SHARE = 0.0
HEAD_SHARE = 1e-6
GRAM_SHARE = 2e-7
# Entries that a task holds before it hands partial counts on.
HELD = 1 << 20
# Bytes that never occur in UTF-8 stand for what is before and behind a text.
START, END = 0xFE, 0xFF
SYMBOLS = 255  # every byte but START


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def grams(bodies: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the ``order`` bytes before it, packed into one number,
    of all bodies; and how many symbols each body has (its end included)."""
    start, end = bytes([START]) * order, bytes([END])
    raw = np.frombuffer(b"".join(x for b in bodies for x in (start, b, end)), np.uint8).astype(np.uint64)
    n = len(raw) - order
    packed = np.zeros(n, np.uint64)
    for k in range(order + 1):
        packed = (packed << np.uint64(8)) | raw[k : k + n]
    return packed[raw[order:] != START], np.array([len(b) + 1 for b in bodies], np.int64)


# --------------------------------------------------------------------------
# Training counts
# --------------------------------------------------------------------------

def count_grams(train: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n) over all rows of ``train`` (text), each gram once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            g = np.concatenate([x for x, _ in held])
            order_ = np.argsort(g, kind="stable")
            g, n = g[order_], np.concatenate([x for _, x in held])[order_]
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            return g[first], np.add.reduceat(n, first)

        def out(part: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1])], names=["gram", "n"])

        for b in slices(batches):
            found, _ = grams([b" ".join(words_of(t)) for t in b.column("text").to_pylist()], order)
            held.append(np.unique(found, return_counts=True))
            if sum(len(x) for x, _ in held) > 2 * HELD:
                held = [merged()]
                if len(held[0][0]) > HELD:
                    yield out(held.pop())
        if held:
            yield out(merged())

    return map_arrow(train.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def count_words(train: DataFrame) -> DataFrame:
    """(word, c) over all rows of ``train`` (text); the empty word counts ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = pa.array(list(held.keys()), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "c"])

        for b in slices(batches):
            for text in b.column("text").to_pylist():
                held.update(words_of(text))
                held[b""] += 1
            if len(held) > HELD // 4:
                yield out()
                held.clear()
        if held:
            yield out()

    return map_arrow(train.select("text"), run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


# --------------------------------------------------------------------------
# The trie
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Trie:
    """The model as written tables, one of each kind for every length of the
    context, from 0. ``entries``: gram and n. ``contexts``: context and the log10
    of what symbol counts are divided by (``total``) and of the chance of an
    escape (``escape``), and both in the next shorter context without this
    one's symbols (``total_x``, ``escape_x``)."""

    order: int
    entries: list[DataFrame]
    contexts: list[DataFrame]
    symbols: int  # how many were counted
    rest: float  # log10 of the chance of each byte that the trie doesn't have

    def scores(self, asked: DataFrame) -> DataFrame:
        """(gram, score): the log10 probability of each of the distinct grams
        ``asked`` (gram), from the longest context down."""
        todo = asked.select("gram", F.lit(0.0).alias("score"), *[F.lit(None).cast("double").alias(c) for c in ("above", "out")])
        found = []
        for k in range(self.order, -1, -1):
            now = todo.withColumn("g", _low("gram", k + 1)).withColumn("c", F.shiftrightunsigned("g", 8))
            now = now.join(_side(self.entries[k].withColumnRenamed("gram", "g"), k + 1), "g", "left")
            now = now.join(_side(self.contexts[k].withColumnRenamed("context", "c"), k), "c", "left")
            known, here = F.col("total").isNotNull(), F.col("n").isNotNull()
            cost = F.when(here, F.log10("n") - F.coalesce("above", "total")).when(known, F.coalesce("out", "escape")).otherwise(0.0)
            now = now.select("gram", (F.col("score") + cost).alias("score"), F.col("total_x").alias("above"), F.col("escape_x").alias("out"), here.alias("here"))
            now = materialize(now, f"ppm-scores-{k}")
            found.append(now.where("here").select("gram", "score"))
            todo = now.where("not here").drop("here")
        out = todo.select("gram", (F.col("score") + F.lit(self.rest)).alias("score"))
        for part in found:
            out = out.unionByName(part)
        return out

    def head(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """The longest grams, sorted, that make up at least ``share`` of all
        symbols (so at most 1 / share of them), and their scores."""
        often = self.entries[self.order].where(F.col("n") >= F.lit(share * self.symbols)).withColumn("context", F.shiftrightunsigned("gram", 8))
        often = often.join(_side(self.contexts[self.order], self.order), "context").select("gram", (F.log10("n") - F.col("total")).alias("score"))
        t = often.toArrow()
        gram, score = t.column(0).to_numpy().astype(np.uint64), t.column(1).to_numpy()
        order = np.argsort(gram)
        return gram[order], score[order]

    def log10(self, packed: np.ndarray) -> np.ndarray:
        """The log10 probability of each packed symbol after its context."""
        asked = self.entries[0].sparkSession.createDataFrame([(int(x),) for x in np.unique(packed)], "gram long")
        score = {r.gram: r.score for r in self.scores(asked).collect()}
        return np.array([score[int(x)] for x in packed])


def _low(gram: str, n: int) -> Column:
    """The last ``n`` bytes of a packed gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * n) - 1))


def _side(table: DataFrame, n: int) -> DataFrame:
    """A table whose keys are ``n`` bytes, as the side of a join: up to two
    bytes (65,536 rows) it is broadcast, else merged at every size."""
    return F.broadcast(table) if n <= 2 else table.hint("merge")


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The place of each x in the sorted table, -1 if it has none."""
    if not len(table):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


def fit(train: DataFrame, *, order: int = ORDER, share: float = SHARE) -> Trie:
    """The trie of all texts of ``train``."""
    level, symbols, least = count_grams(train, order), 0, F.lit(1.0)
    entries, stats, contexts = [None] * (order + 1), [None] * (order + 1), [None] * (order + 1)
    for k in range(order, -1, -1):
        # With each entry how often its symbol follows the next shorter context (at most 256 rows a group).
        above = F.sum("n").over(Window.partitionBy(_low("gram", k))) if k else F.lit(None).cast("long")
        level = materialize(level.withColumn("above", above), f"ppm-level-{k}")
        if k == order:
            symbols = level.agg(F.sum("n")).first()[0] or 0
            least = F.lit(max(1.0, share * symbols))
        kept = F.col("n") >= least
        entries[k] = level.where(kept).select("gram", "n")
        follow = level.groupBy(F.shiftrightunsigned("gram", 8).alias("context")).agg(
            F.count_if(kept).alias("size"), F.sum(F.when(kept, F.col("n"))).alias("own"),
            F.sum(F.when(kept, 0).otherwise(F.col("n"))).alias("rare"), F.sum(F.when(kept, F.col("above"))).alias("gone"))
        stats[k] = materialize(follow.where("size > 0"), f"ppm-stats-{k}")
        if k:
            level = level.groupBy(_low("gram", k).alias("gram")).agg(F.sum("n").alias("n"))
    total, escape = F.col("own") + F.col("size") + F.col("rare"), F.col("size") + F.col("rare")
    for k in range(order + 1):
        # What the next shorter context has left when this one's symbols are ruled out.
        total_x = escape_x = F.lit(None).cast("double")
        rows = stats[k]
        if k:
            parents = stats[k - 1].select(F.col("context").alias("parent"), F.col("own").alias("p_own"), (F.col("size") + F.col("rare")).alias("p_escape"))
            rows = rows.withColumn("parent", _low("context", k - 1)).join(_side(parents, k - 1), "parent")
            out = F.col("p_escape") - F.col("size")
            left = F.col("p_own") - F.col("gone") + out
            total_x, escape_x = F.when(left > 0, F.log10(left)).otherwise(0.0), F.when(left > 0, F.log10(out) - F.log10(left)).otherwise(0.0)
        rows = rows.select("context", F.log10(total).alias("total"), (F.log10(escape) - F.log10(total)).alias("escape"), total_x.alias("total_x"), escape_x.alias("escape_x"))
        contexts[k] = materialize(rows, f"ppm-contexts-{k}")
    return Trie(order, entries, contexts, symbols, -float(np.log10(max(1, SYMBOLS - entries[0].count()))))


# --------------------------------------------------------------------------
# Scores
# --------------------------------------------------------------------------

def score_documents(docs: DataFrame, train: DataFrame, *, order: int = ORDER, share: float = SHARE, head_share: float = HEAD_SHARE,
                    gram_share: float = GRAM_SHARE) -> DataFrame:
    """For every row of ``docs`` (doc_id, text), with all learnt from ``train``
    (text): doc_id, n_tokens, n_known, train_tokens, base_score and score."""
    spark = docs.sparkSession
    trie = fit(train, order=order, share=share)
    often = spark.sparkContext.broadcast(trie.head(gram_share))
    words = materialize(count_words(train), "ppm-words")
    seen, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = words.where(F.col("c") >= F.lit(head_share * seen)).collect()  # at most 1 / head_share rows
    head = spark.sparkContext.broadcast({r.word.encode("utf-8", "surrogatepass"): float(np.log10(r.c + 0.5)) for r in frequent})
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {key}, row long, n_tokens long, n_known long, base double, score double, "
              "tail array<struct<word:string,n:long>>, rare array<struct<gram:long,n:long>>")
    run = _scorer(often, head, order)
    scored = materialize(map_arrow(docs.select("doc_id", "text"), run, schema), "ppm-scored")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n")
    tail = tail.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("tail_base"))
    rare = scored.select("row", F.explode("rare").alias("t")).select("row", "t.gram", "t.n")
    rare = rare.join(trie.scores(rare.select("gram").distinct()).hint("merge"), "gram").groupBy("row").agg(F.sum(F.col("n") * F.col("score")).alias("tail_score"))
    every = float(np.log10(seen + 0.5 * (distinct + 1)))
    return scored.drop("tail", "rare").join(tail, "row", "left").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(seen).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(every)).alias("base_score"),
        (F.col("score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"))


def _scorer(often, head, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        (often_grams, often_scores), common = often.value, head.value
        row = TaskContext.get().partitionId() << 40
        for b in slices(batches):
            n_tokens, known, base, tails, bodies = [], [], [], [], []
            for text in b.column("text").to_pylist():
                tokens = words_of(text)
                bodies.append(b" ".join(tokens))
                tokens.append(b"")
                logs = list(map(common.get, tokens))
                missing = logs.count(None)
                tail = Counter(w for w, x in zip(tokens, logs) if x is None) if missing else {}
                n_tokens.append(len(tokens))
                known.append(len(tokens) - missing)
                base.append(sum(x for x in logs if x is not None) if missing else sum(logs))
                tails.append([{"word": w.decode("utf-8", "surrogatepass"), "n": n} for w, n in tail.items()])
            packed, sizes = grams(bodies, order)
            where, back = np.unique(packed, return_inverse=True)
            place = _find(often_grams, where)
            value = np.zeros(len(where))
            value[place >= 0] = often_scores[place[place >= 0]]
            score = np.add.reduceat(value[back], np.cumsum(sizes) - sizes)
            far = place[back] < 0
            pair, n = np.unique(np.repeat(np.arange(len(bodies)), sizes)[far] * len(where) + back[far], return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(bodies) + 1) * len(where))
            rare = pa.StructArray.from_arrays([pa.array(where[pair % len(where)].view(np.int64)), pa.array(n, pa.int64())], names=["gram", "n"])
            kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.arange(row, row + len(bodies))), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(score), pa.array(tails, kind),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)],
                names=["doc_id", "row", "n_tokens", "n_known", "base", "score", "tail", "rare"])
            row += len(bodies)

    return run
