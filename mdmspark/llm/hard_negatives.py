"""Hard negatives by Fagin's threshold algorithm.

For an anchor, the positives are the best other rows of its label, and the hard
negatives of a positive are the best rows of other labels whose score lies in a
window below the positive's. A score is the integer inner product with the
anchor; ties go to the smaller id (null ids last).

Rows are searched in blocks. A block keeps one list of its rows for each
dimension, sorted by the component. For an anchor the lists are read from the
end that its sign makes best, all at the same depth; rows not met before are
scored whole, by random access. The *threshold* is the score that a row would
have with the last component read from each list: no row still unseen scores
more. A window is settled once the threshold lies strictly below its kth score
(so that ties are seen) or below its lower end, and a block is left once all
windows are settled.

Anchors are dealt into chunks of at most ``ANCHOR_BYTES``; a chunk is broadcast
and meets every block of rows once for its positives and once, with the windows
that these make, for its negatives. A task keeps the best rows of each window
over all its blocks, so it starts a block with the kth scores it has and hands
on few rows, which are ranked per anchor at last. A label or a vector that very
many rows share is nothing special: rows lie in blocks as they come.

Defined results: rows with a null label or vector, or a null or non-finite
component, take no part; of vectors of unequal length the shorter one is filled
up with zeros; repeated rows are rows of their own, each the other's neighbour,
and each an anchor where one is; a null id is no anchor; a score beyond a long
counts as the nearest long; an anchor without positives or a positive without
negatives gives no row; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow, materialize

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
# A negative has a score of at least 80 and at most 100 hundredths of its positive's.
LEAST, MOST = 80, 100
# Vectors of anchors that a broadcast holds, and components of a block (rows times the longest vector).
ANCHOR_BYTES, BLOCK_CELLS = 4 << 20, 1 << 19
# Depth of the first sorted access; it doubles.
DEPTH = 16
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def usable(label: str = "label", vector: str = "embedding") -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def padded(vectors: pa.ListArray) -> np.ndarray:
    """The vectors as rows of a matrix, short ones filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    if flat.size:
        out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``, as doubles while they are exact, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * float(scale))
    if np.abs(scaled).max(initial=0) < 2**53:
        return scaled
    exact = [int(v) * scale if abs(v) >= 2**53 else math.floor(v * scale) for v in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


class Block:
    """Rows with a sorted list for each dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        self.rows, self.ids, self.unnamed, self.labels, self.x = rows, ids, unnamed, labels, x
        self.size = np.abs(x).max(initial=0)
        self.lists = np.argsort(x, axis=0, kind="stable")  # a column for each dimension, ascending

    def exact(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows and the anchor over their common dimensions, as doubles if all sums are exact in them."""
        n = min(len(anchor), self.x.shape[1])
        x, a = self.x[:, :n], anchor[:n]
        if x.dtype == object or a.dtype == object or float(self.size) * float(np.abs(a).max(initial=0)) * max(n, 1) >= 2**53:
            return _whole(x), _whole(a)
        return x, a

    def search(self, anchor: np.ndarray, windows: list["Best"], fits) -> int:
        """Offer rows for which ``fits`` holds to the windows until these are
        settled; how many rows were scored."""
        x, a = self.exact(anchor)
        n, up, down = len(x), np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        seen, depth, to = np.zeros(n, bool), 0, DEPTH
        weights = np.concatenate([a[up], a[down]])
        while depth < n and windows:
            to = min(to, n)
            # Sorted access: the highest components where the anchor's are positive, the lowest where they are negative.
            met = np.concatenate([self.lists[n - to : n - depth, up].ravel(), self.lists[depth:to, down].ravel()])
            if not len(weights):
                met = np.arange(n)  # all scores are zero
                to = n
            fresh = np.zeros(n, bool)
            fresh[met] = True
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            if len(fresh):
                scores = np.clip(x[fresh] @ a, LOW, HIGH) if x.dtype == object else x[fresh] @ a
                good = fits(fresh)
                for w in windows:
                    w.offer(scores[good], fresh[good], self)
            last = np.concatenate([x[self.lists[n - to, up], up], x[self.lists[to - 1, down], down]])
            threshold = (last * weights).sum() if len(last) else 0
            windows = [w for w in windows if not threshold < w.floor()]
            depth, to = to, 2 * to
        return int(seen.sum())


def _whole(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


class Best:
    """The best ``k`` rows with scores from ``low`` to ``high``."""

    __slots__ = ("k", "low", "high", "kept")

    def __init__(self, k: int, low: int | None = None, high: int | None = None) -> None:
        self.k, self.low, self.high, self.kept = k, low, high, []

    def floor(self) -> float:
        """A score below this one changes nothing."""
        if len(self.kept) < self.k:
            return -math.inf if self.low is None else self.low
        return -self.kept[-1][0]

    def offer(self, scores: np.ndarray, at: np.ndarray, block: Block) -> None:
        inside = scores >= self.floor()
        if self.high is not None:
            inside &= scores <= self.high
        found = np.flatnonzero(inside.astype(bool))
        if len(found) > 4 * self.k:
            # All that can be among the best k, ties included.
            least = sorted(scores[found].tolist(), reverse=True)[self.k - 1]
            found = found[(scores[found] >= least).astype(bool)]
            if len(found) > 4 * self.k and scores.dtype != object:  # many ties: ids decide
                place = at[found]
                found = found[np.lexsort((block.rows[place], block.ids[place], block.unnamed[place], -scores[found]))][: self.k]
        if len(found):
            place = at[found]
            entries = zip((-int(s) for s in scores[found].tolist()), block.unnamed[place].tolist(), block.ids[place].tolist(), block.rows[place].tolist())
            self.kept = sorted([*self.kept, *entries])[: self.k]


class Anchors:
    """A chunk of anchors: rows, ids, labels and integer vectors."""

    def __init__(self, found: list, scale: int) -> None:
        self.rows, self.ids, self.labels = [r.row for r in found], [r.vec_id for r in found], [r.label for r in found]
        self.vectors = [integers(np.array(r.embedding, np.float64), scale) for r in found]


def blocks(batches: Iterator[pa.RecordBatch], scale: int, cells: int) -> Iterator[Block]:
    """The rows in blocks of at most ``cells`` components (a longer vector is a block of its own)."""
    held: list[pa.RecordBatch] = []
    rows = longest = 0
    for b in batches:
        sizes = np.diff(b.column("embedding").offsets.to_numpy())
        at = 0
        while at < b.num_rows:
            # As many rows as fit behind those held, at least one.
            widths = np.maximum(np.maximum.accumulate(sizes[at:]), longest)
            fit = int(np.searchsorted(widths * (rows + np.arange(1, len(widths) + 1)), cells, "right"))
            if not fit and rows:
                yield _block(held, scale)
                held, rows, longest = [], 0, 0
                continue
            fit = max(fit, 1)
            held.append(b.slice(at, fit))
            rows, longest, at = rows + fit, int(widths[fit - 1]), at + fit
            if at < b.num_rows:
                yield _block(held, scale)
                held, rows, longest = [], 0, 0
    if held:
        yield _block(held, scale)


def _block(held: list[pa.RecordBatch], scale: int) -> Block:
    b = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    ids = b.column("vec_id")
    return Block(b.column("row").to_numpy(), ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null()),
                 b.column("label").to_numpy(zero_copy_only=False), integers(padded(b.column("embedding")), scale))


_FOUND = "anchor int, window int, score long, vec_id long, row long"


def _search(table: DataFrame, shared, windows, same: bool, scale: int, cells: int) -> DataFrame:
    """The best rows of every window of every anchor of the chunk, per task.
    ``windows(i)`` gives fresh windows of anchor i; ``same``: rows of its label, else of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = shared.value[0], {}
        for block in blocks(batches, scale, cells):
            for i, a in enumerate(anchors.vectors):
                open_ = best[i] if i in best else best.setdefault(i, windows(shared.value, i))
                if not open_:
                    continue
                label, row = anchors.labels[i], anchors.rows[i]
                fits = (lambda at: (block.labels[at] == label) & (block.rows[at] != row)) if same else (lambda at: block.labels[at] != label)
                block.search(a, open_, fits)
        found = [(i, w, -s, None if unnamed else v, row) for i, ws in best.items() for w, b in enumerate(ws) for s, unnamed, v, row in b.kept]
        if found:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["anchor", "window", "score", "vec_id", "row"])

    return map_arrow(table, run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def chunks(anchors: DataFrame, scale: int, most: int) -> Iterator:
    """The anchors in chunks of about ``most`` bytes of vectors; the driver holds one at a time."""
    size = anchors.agg(F.coalesce(F.sum(F.size("embedding") * 8 + 64), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / most))
    dealt = anchors.withColumn("_chunk", F.pmod(F.xxhash64("row"), F.lit(n)))
    for i in range(n):
        yield Anchors(dealt.where(F.col("_chunk") == i).select("row", "vec_id", "label", "embedding").collect(), scale), n == 1


def mine(vectors: DataFrame, anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         scale: int = SCALE, anchor_bytes: int = ANCHOR_BYTES, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """Hard negatives among the rows of ``vectors`` (vec_id long, label,
    embedding) for the rows where ``anchor`` holds: anchor_id, positive_id,
    positive_rank, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    kept = vectors.where(usable()).select(F.col("vec_id").cast("long"), "label", "embedding", F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    # Row ids are fixed by writing them.
    table = materialize(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    rows = table.select("row", "vec_id", "label", "embedding")
    parts = []
    for chunk, only in chunks(table.where("is_anchor"), scale, anchor_bytes):
        first = spark.sparkContext.broadcast((chunk, None))
        near = _ranked(_search(rows, first, lambda _, i: [Best(positives)], True, scale, block_cells), positives).collect()  # at most ``positives`` an anchor
        by_anchor: list[list] = [[] for _ in chunk.rows]
        for r in sorted(near, key=lambda r: (r.anchor, r.rank)):
            by_anchor[r.anchor].append((r.vec_id, r.score))
        # least * p <= 100 * s <= most * p, in integers.
        spans = [[(-(-least * p // 100), most * p // 100) for _, p in ps] for ps in by_anchor]
        second = spark.sparkContext.broadcast((chunk, spans))
        far = _ranked(_search(rows, second, lambda shared, i: [Best(negatives, a, b) for a, b in shared[1][i]], False, scale, block_cells), negatives)
        named = spark.createDataFrame([(i, w, chunk.ids[i], v, p) for i, ps in enumerate(by_anchor) for w, (v, p) in enumerate(ps)],
                                      "anchor int, window int, anchor_id long, positive_id long, positive_score long")
        # As many rows as positives of one chunk.
        out = far.join(F.broadcast(named), ["anchor", "window"])
        out = out.select("anchor_id", "positive_id", (F.col("window") + 1).alias("positive_rank"), F.col("rank").cast("int").alias("rank"),
                         F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        parts.append(out if only else materialize(out, "hard-negatives"))
        if not only:
            first.destroy()
            second.destroy()
    return reduce(DataFrame.unionByName, parts)
