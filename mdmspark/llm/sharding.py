"""Contiguous shards with the smallest possible largest shard.

Rows with equal keys form an atomic group; groups stand in a fixed order. The
smallest capacity under which the groups, cut into consecutive shards, need no
more than ``n_shards`` is found by binary search, each capacity checked by
greedy filling; the groups are then cut there.

A greedy fill only asks for the last group boundary at or below a position, so
the driver holds a sketch of the boundaries (first and last boundary of each
of at most ``SKETCH`` cells of the size axis), not the groups. Cells where a
cut of any capacity still in question can fall are then looked up more finely,
until the sketch decides the search exactly.

Where one group is so large that the smallest capacity fills only some of the
shards, the cuts go as near to equal parts as that capacity allows.

Defined results: a null key or text counts as an empty one; repeated rows stay
apart (each gets a slot); fewer groups than shards leave shards empty; an
empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.llm.common import map_arrow, materialize, running_totals

# Boundaries that the driver holds at a time (cells of the sketch in each pass).
SKETCH = 1 << 15


class Boundaries:
    """What is known of the sorted group ends: some of them (``at``), and for
    each stretch between two known ones whether more lie there."""

    def __init__(self, total: int) -> None:
        self.total = total
        self.at = [0, total]
        self.open = [True]  # open[i]: unknown boundaries between at[i] and at[i + 1]

    def refine(self, cells: list[tuple[int, int, int]], looked_at: list[tuple[int, int]]) -> None:
        """``cells``: (first, last, count) of the boundaries in each cell of
        the stretches ``looked_at``, whose insides are known from now on."""
        still = {(a, b) for a, b, o in zip(self.at, self.at[1:], self.open) if o} - set(looked_at)
        for first, last, n in cells:
            if n > 2:
                still.add((first, last))
        known = sorted({*self.at, *(c[0] for c in cells), *(c[1] for c in cells)})
        self.at, self.open = known, [(a, b) in still for a, b in zip(known, known[1:])]

    def below(self, x: int, hopeful: bool) -> int:
        """The last boundary at or below x; where that isn't known, the last
        known one, or x itself if ``hopeful``."""
        i = bisect_right(self.at, x) - 1
        return x if hopeful and i < len(self.open) and self.open[i] and self.at[i] < x else self.at[i]

    def fill(self, capacity: int, n: int, hopeful: bool, start: int = 0) -> list[int] | None:
        """Greedy cuts (ends of the shards) from ``start``; None if n shards of ``capacity`` don't hold all."""
        cuts, at = [], start
        while at < self.total:
            to = self.below(at + capacity, hopeful)
            if len(cuts) == n or to <= at:
                return None
            cuts.append(to)
            at = to
        return cuts

    def smallest(self, low: int, n: int, hopeful: bool) -> int:
        high = self.total
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.fill(mid, n, hopeful) is not None else (mid + 1, high)
        return low


def smallest_capacity(total: int, largest: int, n: int, look) -> tuple[int, Boundaries]:
    """The smallest feasible capacity and the boundaries around its cuts.
    ``look(stretches)`` gives the cells (first, last, count) of the boundaries
    inside each stretch (a, b], in at most :data:`SKETCH` cells."""
    known = Boundaries(total)
    stretches = [(0, total)]
    while True:
        known.refine(look(stretches), stretches)
        low = known.smallest(max(largest, -(-total // n)), n, True)
        high = known.smallest(low, n, False)
        if low == high:
            return low, known
        # The true capacity lies in [low, high], so its j-th cut lies between
        # the cautious cut under ``low`` and the hopeful one under ``high``.
        stretches, at = [], [0, 0]
        for _ in range(n):
            at = [known.below(at[0] + low, False), min(total, known.below(at[1] + high, True))]
            i = max(0, bisect_right(known.at, at[0]) - 1)
            while i < len(known.open) and known.at[i] <= at[1]:
                if known.open[i]:
                    stretches.append((known.at[i], known.at[i + 1]))
                i += 1
        stretches = sorted(set(stretches))


def cells(ends: DataFrame, stretches: list[tuple[int, int]]) -> DataFrame:
    """The rows of ``ends`` inside the disjoint stretches (a, b] with the
    number of their stretch and of their cell in it."""
    low, high = np.array(stretches, np.int64).T
    width = max(1, int((high - low).sum()) * 2 // SKETCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            end = b.column("end").to_numpy(zero_copy_only=False)
            i = np.searchsorted(low, end, "left") - 1
            inside = (i >= 0) & (end <= high[i])
            end, i = end[inside], i[inside]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array((end - low[i] - 1) // width), pa.array(end)], names=["stretch", "cell", "end"])

    return map_arrow(ends, run, "stretch long, cell long, end long")


def even_cuts(known: Boundaries, capacity: int, n: int) -> list[int]:
    """Ends of ``n`` shards within ``capacity``, each as near to an equal part
    of what is left as the shards behind it allow."""
    cuts, at = [], 0
    for j in range(n - 1):
        left = n - j - 1
        goal = at + (known.total - at) / (left + 1)
        i, top = bisect_right(known.at, at), bisect_right(known.at, at + capacity)
        options = sorted(known.at[max(i, bisect_right(known.at, goal) - 8) : min(top, bisect_right(known.at, goal) + 8)], key=lambda x: abs(x - goal))
        greedy = known.below(at + capacity, False)
        at = next((x for x in options if known.fill(capacity, left, False, x) is not None), max(at, greedy))
        cuts.append(at)
    return [*cuts, known.total]


def minimax_shards(rows: DataFrame, size: str, key: Column, order: str, n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from
    0 in each shard). Rows with equal ``key`` stay together; groups stand in
    the order of their smallest ``order``, rows of a group in its order.

    Keys are held as 128-bit digests. Groups are summed map-side first, so a
    group with a third of all rows costs one row a task; its rows are then
    joined back (a skewed join that Spark splits) and numbered by ranges.
    """
    base = materialize(rows.withColumns({"_key": F.md5(key), "_size": F.coalesce(F.col(size), F.lit(0)).cast("long")}), "shard-rows")
    groups = base.groupBy("_key").agg(F.min(order).alias("_first"), F.sum("_size").alias("_bytes"))
    groups = materialize(running_totals(groups, ["_first", "_key"], {"_start": "_bytes"}, "shard-groups"), "shard-starts")
    total, largest = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.coalesce(F.max("_bytes"), F.lit(0))).first()
    if not total:
        cuts = [0] * n_shards
    else:
        ends = groups.select((F.col("_start") + F.col("_bytes")).alias("end"))

        def look(stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
            found = cells(ends, stretches).groupBy("stretch", "cell").agg(F.min("end").alias("x"), F.max("end").alias("y"), F.count("end").alias("n"))
            return [(r.x, r.y, r.n) for r in found.collect()]

        capacity, known = smallest_capacity(total, largest, n_shards, look)
        cuts = even_cuts(known, capacity, n_shards)
    placed = groups.select("_key", "_first", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("_start"))).alias("shard"))
    placed = placed.withColumn("shard", F.least("shard", F.lit(n_shards - 1)))
    joined = base.join(placed, "_key")
    tie = ["shard", "_first", "_key", order]
    numbered = running_totals(joined.withColumn("_one", F.lit(1).cast("long")), tie, {"_at": "_one"}, "shard-slots")
    numbered = materialize(numbered, "shard-numbered")
    firsts = numbered.groupBy("shard").agg(F.min("_at").alias("_from"))  # one row a shard
    out = numbered.join(F.broadcast(firsts), "shard")
    return out.select(*rows.columns, "shard", (F.col("_at") - F.col("_from")).alias("slot"))
