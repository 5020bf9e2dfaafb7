"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints that differ in at most ``distance`` bits are linked; a component
is everything reachable over links.

The search works on distinct fingerprints, so copies cost one entry:

1. *Upper nodes.* The 64 bits are cut into ``distance + 1`` blocks; two linked
   fingerprints agree on one block at least. Each block mask with the bits
   under it is an upper node, a masked pattern that its members share, and
   fingerprints are dealt to the node of each mask. A node with more than
   ``NODE`` members is split the same way by the bits outside its mask (its
   pattern grows), until it is small or no bits are left; nothing is dropped.
2. *Within a node* members are sorted by Gray rank, so neighbours differ in
   few bits, and grouped bottom-up; each group keeps the mask and the pattern
   that all its members share. Pairs of groups are followed from the top, and
   a pair is pruned as a whole once the differences of the shared bits exceed
   the distance.
3. A node only reports a spanning forest of its links (at most one edge per
   member), which has the same components; components over all nodes are found
   by rewiring edges to smaller neighbours until nothing changes.

Defined results: a text without words (null, empty) has fingerprint zero and
is linked like any other; equal fingerprints are one entry; repeated rows get
the same component; an empty table gives an empty result. A null doc_id keeps
its row, and counts for no component's smallest id (null if it has no other).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow, materialize, slices

SHINGLE, DISTANCE, SEED = 3, 2, 42
# Members of an upper node that one task holds at a time; larger nodes are split.
NODE = 4096
# Fingerprints in a leaf of the Gray-order tree, and children of its inner nodes.
LEAF, FAN = 32, 8


def shingle_hashes(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle of ``n`` words of the text, A-Z in lower case,
    as unsigned 64-bit numbers; fewer words make one shingle, none make none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    grams = zip(*(words[i:] for i in range(n))) if len(words) > n else [words]
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(b" ".join(g), SEED) for g in grams), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in range(64) if 2 * int(ones[i]) > len(hashes))


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id and ``fp`` (the fingerprint's bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(shingle_hashes(t, n)) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {key}, fp long")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --------------------------------------------------------------------------
# Upper nodes
# --------------------------------------------------------------------------

def split_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """``mask`` and one of ``distance + 1`` blocks of the bits outside it, for each block."""
    rest = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << rest[i] for i in part) for part in np.array_split(np.arange(len(rest)), distance + 1) if len(part)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def upper_nodes(fps: DataFrame, distance: int, most: int) -> DataFrame:
    """(mask, pattern, fp): the nodes of at most ``most`` members in which
    every linked pair of ``fps`` (distinct ``fp``) meets."""
    masks, done, depth = [0], None, 0
    open_nodes = fps.select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("pattern"), "fp")
    while True:
        finer = F.create_map(*[F.lit(x) for m in masks for x in (_signed(m), [_signed(s) for s in split_masks(m, distance)])])
        dealt = open_nodes.withColumn("mask", F.explode(finer[F.col("mask")]))
        dealt = materialize(dealt.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask"))), f"simhash-nodes-{depth}")
        sizes = dealt.groupBy("mask", "pattern").count()
        crowded = materialize(sizes.where((F.col("count") > most) & (F.bit_count("mask") < 64)).select("mask", "pattern"), f"simhash-crowded-{depth}")
        small = dealt.join(crowded, ["mask", "pattern"], "left_anti")
        done = small if done is None else done.unionByName(small)
        masks = sorted(r.mask & (1 << 64) - 1 for r in crowded.select("mask").distinct().collect())  # at most (distance + 1) ** depth
        if not masks:
            return done
        open_nodes, depth = dealt.join(crowded, ["mask", "pattern"], "left_semi"), depth + 1


# --------------------------------------------------------------------------
# The Gray-order tree of one node
# --------------------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray order."""
    x = x.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def gray_tree(codes: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of the tree over ``codes`` (in Gray order), leaves first: the
    starts of the groups in the level below, and the mask and the pattern that
    each group's codes share."""
    levels, width = [], leaf
    ones, zeros = codes, codes
    while True:
        starts = np.arange(0, len(ones), width)
        ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_or.reduceat(zeros, starts)
        mask = ~(ones ^ zeros)
        levels.append((starts, mask, ones & mask))
        if len(starts) <= 1:
            return levels
        width = fan


def linked_pairs(codes: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of the codes, sorted by Gray rank, that differ in at most ``distance`` bits, in parts."""
    levels = gray_tree(codes)
    a = b = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        _, mask, pattern = levels[depth]
        kept = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= distance
        a, b = a[kept], b[kept]
        below = len(levels[depth - 1][0]) if depth else len(codes)
        width = FAN if depth else LEAF
        if depth:
            a, b = _children(a, b, width, below)
        else:
            for at in range(0, len(a), 512):
                i, j = _children(a[at : at + 512], b[at : at + 512], width, below)
                near = (i != j) & (np.bitwise_count(codes[i] ^ codes[j]) <= distance)
                yield i[near], j[near]


def _children(a: np.ndarray, b: np.ndarray, width: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i <= j) of a child of ``a`` and a child of ``b``."""
    step = np.arange(width)
    i = np.broadcast_to((a[:, None] * width + step)[:, :, None], (len(a), width, width)).ravel()
    j = np.broadcast_to((b[:, None] * width + step)[:, None, :], (len(a), width, width)).ravel()
    kept = (i < below) & (j < below) & (i <= j)
    return i[kept], j[kept]


def forest(codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Edges (child, root) with the components of the links among distinct ``codes``."""
    codes = codes[np.argsort(gray_rank(codes), kind="stable")]
    root = np.arange(len(codes))
    for i, j in linked_pairs(codes, distance):
        while len(i):
            x, y = _roots(root, i), _roots(root, j)
            apart = x != y
            if not apart.any():
                break
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
    root = _roots(root, root)
    child = np.flatnonzero(root != np.arange(len(codes)))
    return codes[child], codes[root[child]]


def _roots(root: np.ndarray, x: np.ndarray) -> np.ndarray:
    x = root[x]
    while (up := root[x]).size and (up != x).any():
        x = up
    return x


def node_edges(nodes: DataFrame, distance: int) -> DataFrame:
    """Spanning edges (u, v) of every node's links. Tasks hold whole nodes of bounded size, one at a time."""
    order = ["mask", "pattern"]
    dealt = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None

        def close() -> pa.RecordBatch:
            u, v = forest(np.concatenate(held).view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for b in batches:
            mask, pattern, fp = (b.column(c).to_numpy(zero_copy_only=False) for c in (*order, "fp"))
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fp)]):
                if hi > lo:
                    if held and (mask[lo], pattern[lo]) != last:
                        if sum(map(len, held)) > 1:
                            yield close()
                        held.clear()
                    last = (mask[lo], pattern[lo])
                    held.append(fp[lo:hi])
        if held:
            yield close()

    return map_arrow(dealt.select(*order, "fp"), run, "u long, v long").where("u != v")


# --------------------------------------------------------------------------
# Components
# --------------------------------------------------------------------------

def components(edges: DataFrame, name: str = "components", rounds: int = 200) -> DataFrame:
    """(node, component): for every node of ``edges`` (u, v) the smallest node
    reachable. Each round first points a node's larger neighbours, then its
    smaller ones, to its smallest neighbour; both sides are grouped and joined
    by key, and each round is a written table. An error if ``rounds`` don't settle it."""
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), f"{name}-edges")
    mark = None
    for turn in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The smallest neighbours are a written table, so that the join below has
        # nothing but an exchange on either side and Spark can split a hub.
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), f"{name}-{turn}m")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.unionByName(least.where("u != m").select("u", F.col("m").alias("v"))).where("u != v").distinct(), f"{name}-{turn}a")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{turn}n")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), f"{name}-{turn}b")
        state = now.select("u", "v").agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == mark:
            break
        mark = state
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, distance: int = DISTANCE, node: int = NODE) -> DataFrame:
    """doc_id, ``fp`` and ``component_id`` (the smallest doc_id reachable) of every row of ``docs`` (doc_id, text)."""
    marked = materialize(fingerprints(docs, shingle), "simhash-fps")
    # Components of fingerprints first (over the fingerprints themselves), then their smallest document.
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = components(node_edges(upper_nodes(distinct.select("fp"), distance, node), distance), "simhash")
    placed = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    placed = materialize(placed, "simhash-placed")
    smallest = materialize(placed.groupBy("component").agg(F.min("first").alias("component_id")), "simhash-smallest")
    ids = materialize(placed.join(smallest, "component").select("fp", "component_id"), "simhash-ids")
    return marked.join(ids, "fp").select("doc_id", "fp", "component_id")


def with_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, where each row lies: its file and its place there.
    Frames that are no plain scan of files are written first."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return docs.withColumn("_row", place)
    except AnalysisException:
        return materialize(docs, "simhash-docs").withColumn("_row", place)


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each component of ``docs`` (doc_id, text): the one with the
    smallest doc_id (a null one comes last), of rows that share it the first
    by file and place. Repeated rows and rows without a doc_id are copies like
    any other.

    Rows are known by where they lie. The rows that go are a written list of
    places, the smaller side: Spark broadcasts it below its threshold, and else
    shuffles."""
    docs = docs.drop("_row") if "_row" in docs.columns else docs
    rows = with_rows(docs)
    one = rows.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row").alias("doc_id"), "text")
    found = materialize(near_duplicates(one, **options), "simhash-found")
    gone = materialize(found.where("doc_id != component_id").select(F.col("doc_id._row").alias("_gone")), "simhash-gone")
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select(*docs.columns)
