"""Benchmark decontamination by greedy string tiling.

A document is compared with every benchmark item that shares a seed with it
(``seed`` consecutive tokens). Tiling repeatedly marks the longest run of
unmarked tokens common to both, found by running Karp-Rabin hashes, until no
common run of ``seed`` tokens is left; tiles never overlap, and their order in
the document does not matter, so reordered passages are caught. An item whose
tokens are covered to at least ``threshold`` contaminates the document.

Tokens are runs of letters and digits in lower case. The benchmark is the
query side: it is held by every task in blocks of at most ``BLOCK_BYTES`` of
text, one pass over the documents a block (each pass is written before the
next block is made), so its size bounds memory at any number of items;
documents are neither shuffled nor sampled.

Defined results: null or empty texts, on either side, match nothing, nor do
items shorter than a seed (unless the whole item is: then all its tokens make
one seed); repeated documents give rows of their own, repeated items too; an
empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mdmspark.llm.common import map_arrow, materialize, slices

SEED, THRESHOLD = 5, 0.5
# Benchmark text that a task holds at a time.
BLOCK_BYTES = 16 << 20

_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Windows up to this size are hashed modulo 2 ** 64, longer ones modulo these primes (below 2 ** 31, so products fit).
SHORT, _PRIMES = 256, (np.uint64(2147483647), np.uint64(2147483629))


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Running Karp-Rabin hashes of all windows of ``size`` ids, each from the
    hashes of its two halves. Short windows are hashed modulo 2 ** 64. Long
    ones are hashed modulo two primes: modulo a power of two, regular sequences
    of some thousand ids agree whatever the base. Equal hashes never count
    as equal ids; see :func:`tile`."""
    if len(ids) < size:
        return np.zeros(0, np.uint64)
    ids = ids.astype(np.uint64) + np.uint64(1)
    if size <= SHORT:
        with np.errstate(over="ignore"):
            return _rolling(ids, size, _BASE, lambda x: x)
    low, high = (_rolling(ids % p, size, np.uint64(int(_BASE) % int(p)), lambda x, p=p: x % p) for p in _PRIMES)
    return high << np.uint64(32) | low


def _rolling(ids: np.ndarray, size: int, base, reduced) -> np.ndarray:
    """Horner's rule by doubling: a window is its two halves."""
    n = len(ids) - size + 1
    parts, width, made = {1: ids}, 1, {1: base}
    while 2 * width <= size:
        half = parts[width]
        parts[2 * width] = reduced(half[:-width] * made[width] + half[width:])
        made[2 * width] = reduced(made[width] * made[width])
        width *= 2
    out, at = None, 0
    for w in sorted(parts, reverse=True):
        if size & w:
            piece = parts[w][at : at + n]
            out = piece.copy() if out is None else reduced(out * made[w] + piece)
            at += w
    return out


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in doc, start in item, length) of a greedy tiling with runs
    of at least ``least`` ids; unknown ids are negative and match nothing.
    Ties go to the first place in the item, then in the document.

    Runs with equal hashes are compared id by id, in the search for the longest
    as well, so the result is exact under any collision. Each turn marks at
    least one run, so it ends."""
    doc_free, item_free, tiles = doc >= 0, np.ones(len(item), bool), []
    size = min(len(item), len(doc))
    while size >= least:
        size = _longest(doc, item, doc_free, item_free, least, size)
        if not size:
            break
        for i, j in _matches(doc, item, doc_free, item_free, size):
            tiles.append((i, j, size))
            doc_free[i : i + size] = False
            item_free[j : j + size] = False
    return tiles


def _open_windows(ids: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of unmarked ids."""
    if len(ids) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    starts = np.flatnonzero(taken[size:] == taken[:-size])
    return starts, windows(ids, size)[starts] if len(starts) else np.zeros(0, np.uint64)


def _longest(doc, item, doc_free, item_free, least: int, most: int) -> int:
    """The longest run common to unmarked ids, 0 if shorter than ``least``.
    Runs of a length contain runs of every smaller one, so bisection finds it."""
    low, high = least - 1, most
    while low < high:
        mid = (low + high + 1) // 2
        found = next(_matches(doc, item, doc_free, item_free, mid), None)
        low, high = (mid, high) if found else (low, mid - 1)
    return low if low >= least else 0


def _matches(doc, item, doc_free, item_free, size: int) -> Iterator[tuple[int, int]]:
    """Pairs of places with equal unmarked runs of ``size``, compared id by id,
    item's order first. Marks made between two of them are heeded: a place in
    the document that is marked is passed over once for all."""
    starts, a = _open_windows(doc, doc_free, size)
    places, b = _open_windows(item, item_free, size)
    if not len(a) or not len(b):
        return
    order = np.argsort(a, kind="stable")
    starts, a = starts[order], a[order]
    first, end = np.searchsorted(a, b, "left"), np.searchsorted(a, b, "right")
    gone: dict[int, int] = {}  # how many of a hash's places, from its first on, are marked
    for j, lo, hi in zip(places.tolist(), first.tolist(), end.tolist()):
        if lo == hi or not item_free[j] or not item_free[j + size - 1]:
            continue
        at = max(lo, gone.get(lo, lo))
        while at < hi and not (doc_free[starts[at]] and doc_free[starts[at] + size - 1]):
            at += 1
        gone[lo] = at
        for i in starts[at:hi].tolist():
            # Marks are whole runs of this size or longer ones of turns before, so a run is free if its ends are.
            if doc_free[i] and doc_free[i + size - 1] and (doc[i : i + size] == item[j : j + size]).all():
                yield i, j
                break


class Block:
    """A block of items, its vocabulary and its seeds."""

    def __init__(self, items: list[tuple], seed: int) -> None:
        texts = [(i, tokens(t)) for i, t in items]
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in texts for w in ws))}
        self.items = [(i, np.array([self.vocabulary[w] for w in ws], np.int64)) for i, ws in texts if ws]
        self.sizes = sorted({min(seed, len(x)) for _, x in self.items})
        self.seeds = {}
        for size in self.sizes:
            own = [(k, windows(x, size)) for k, (_, x) in enumerate(self.items) if min(seed, len(x)) == size]
            hashes, at = np.concatenate([h for _, h in own]), np.concatenate([np.full(len(h), k) for k, h in own])
            order = np.argsort(hashes, kind="stable")
            self.seeds[size] = hashes[order], at[order]

    def ids(self, text: str | None) -> np.ndarray:
        words, get = tokens(text), self.vocabulary.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def candidates(self, ids: np.ndarray) -> list[int]:
        """Items that share a seed with the document."""
        found: set[int] = set()
        for size in self.sizes:
            _, here = _open_windows(ids, ids >= 0, size)
            hashes, at = self.seeds[size]
            here = np.unique(here)
            lo, hi = np.searchsorted(hashes, here, "left"), np.searchsorted(hashes, here, "right")
            for a, b in zip(lo[hi > lo], hi[hi > lo]):
                found.update(at[a:b].tolist())
        return sorted(found)


def _blocks(benchmark: DataFrame, seed: int, block_bytes: int) -> Iterator:
    """The benchmark as broadcast blocks, and whether there is only one; the driver holds one at a time."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / block_bytes))
    dealt = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for k in range(n):
        part = [(r.item_id, r.text) for r in dealt.where(F.col("_block") == k).collect()]
        yield benchmark.sparkSession.sparkContext.broadcast(Block(part, seed)), n == 1


def overlaps(block: Block, text: str | None, seed: int, threshold: float) -> Iterator[tuple]:
    """(item_id, tokens of the item, tiles) of the block's items that contaminate the text."""
    ids = block.ids(text)
    for c in block.candidates(ids):
        item_id, item = block.items[c]
        tiles = tile(ids, item, min(seed, len(item)))
        if sum(t[2] for t in tiles) >= threshold * len(item):
            yield item_id, len(item), tiles


def contaminated(docs: DataFrame, benchmark: DataFrame, *, seed: int = SEED, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text) and item of
    ``benchmark`` (item_id, text) with coverage of at least ``threshold``:
    doc_id, item_id, n_tiles, n_covered, n_item_tokens, coverage and ``tiles``
    (start in the document, start in the item, length, in tokens)."""
    key = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType
    schema = (f"doc_id {key}, item_id {item_type.simpleString()}, n_tiles long, n_covered long, n_item_tokens long, coverage double, "
              "tiles array<struct<doc_start:long,item_start:long,length:long>>")
    places = pa.list_(pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))
    names = ["doc_id", "item_id", "n_tiles", "n_covered", "n_item_tokens", "coverage", "tiles"]
    item_kind = to_arrow_type(item_type)

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                texts = b.column("text").to_pylist()
                rows = [(k, *found) for k, t in enumerate(texts) for found in overlaps(shared.value, t, seed, threshold)]
                if rows:
                    at, item, size, tiles = zip(*rows)
                    covered = [sum(t[2] for t in ts) for ts in tiles]
                    spots = [[dict(zip(("doc_start", "item_start", "length"), t)) for t in ts] for ts in tiles]
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(item, item_kind), pa.array(map(len, tiles), pa.int64()),
                         pa.array(covered, pa.int64()), pa.array(size, pa.int64()), pa.array(np.array(covered) / np.array(size)), pa.array(spots, places)],
                        names=names)

        return run

    parts = []
    for block, only in _blocks(benchmark, seed, block_bytes):
        found = map_arrow(docs.select("doc_id", "text"), search(block), schema)
        parts.append(found if only else materialize(found, "tiles"))
        if not only:
            block.destroy()
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, seed: int = SEED, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns.
    Each block filters what the block before left: narrow, no shuffle (and, for a
    benchmark of one block, no write in between)."""

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                clean = [next(overlaps(shared.value, t, seed, threshold), None) is None for t in b.column("text").to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        return run

    for block, only in _blocks(benchmark, seed, block_bytes):
        docs = map_arrow(docs, search(block), docs.schema)
        if not only:
            docs = materialize(docs, "untainted")
            block.destroy()
    return docs
