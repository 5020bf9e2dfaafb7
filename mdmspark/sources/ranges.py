"""Equi-depth ranges of a column.

Equal-width ranges between the smallest and the largest id leave nearly all
rows to one connection when one id is far off. Here the source counts cells of
the column, heavy cells are cut again between the smallest and largest value
that they really hold, and neighbouring cells are then joined to ranges of
about equal counts. Each pass is one aggregate query over the column that
returns a row per cell, and splits a heavy cell further by a factor of
``CELLS`` over the number of heavy cells, so a few passes do.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

# Cells of a pass, that is, branches of its query and rows of its answer.
CELLS = 512


@dataclass(frozen=True)
class JdbcRanges:
    """Ranges of ``column``: range i holds values from ``bounds[i - 1]`` up to
    below ``bounds[i]``; the first and the last are open-ended, so rows that
    have come since the count are read, too. NULLs have a range of their own."""

    column: str
    bounds: tuple[int, ...]
    counts: tuple[int, ...]
    null_rows: int = 0

    def predicates(self) -> list[str]:
        """One condition a connection; every row meets exactly one."""
        c, cuts = self.column, self.bounds
        if not cuts:
            return [f"{c} IS NOT NULL", f"{c} IS NULL"]
        inner = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:])]
        return [f"{c} < {cuts[0]}", *inner, f"{c} >= {cuts[-1]}", f"{c} IS NULL"]


@dataclass(frozen=True)
class _Cell:
    low: int
    high: int
    rows: int


def cells_sql(table: str, column: str, cells: list[tuple[int, int]]) -> str:
    """Rows, smallest and largest value of each cell (from, to inclusive); NULLs are cell -1."""
    if not cells:
        return f"SELECT 0 AS cell, COUNT({column}) AS n, MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) - COUNT({column}) AS nulls FROM {table}"
    # Cells in rising order, so each needs to name its upper end only.
    branches = " ".join(f"WHEN {column} <= {hi} THEN {i}" for i, (_, hi) in enumerate(cells))
    inside = " OR ".join(f"{column} BETWEEN {lo} AND {hi}" for lo, hi in _joined(cells))
    return (f"SELECT cell, COUNT(*) AS n, MIN(v) AS lo, MAX(v) AS hi, 0 AS nulls FROM "
            f"(SELECT CASE {branches} END AS cell, {column} AS v FROM {table} WHERE {inside}) q GROUP BY cell")


def _joined(cells: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Adjacent cells as one stretch."""
    out: list[tuple[int, int]] = []
    for lo, hi in cells:
        if out and out[-1][1] + 1 == lo:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _cut(cell: _Cell, parts: int) -> list[tuple[int, int]]:
    width = max(1, -(-(cell.high - cell.low + 1) // parts))
    return [(a, min(a + width - 1, cell.high)) for a in range(cell.low, cell.high + 1, width)]


def equi_depth_ranges(run: Callable[[str], DataFrame], table: str, column: str, num_ranges: int, cells: int = CELLS) -> JdbcRanges:
    """Ranges of an integer ``column`` of ``table`` with at most twice the mean
    count each; ``run`` sends a query to the source. Only a single value with
    more rows than that makes a longer range (of that value alone)."""
    if num_ranges < 1:
        raise ValueError("num_ranges must be >= 1")
    first = run(cells_sql(table, column, [])).first()
    if first["lo"] is None:
        return JdbcRanges(column, (), (), int(first["nulls"]))
    found = [_Cell(math.floor(first["lo"]), math.ceil(first["hi"]), int(first["n"]))]
    mean = max(1, math.ceil(found[0].rows / num_ranges))
    while heavy := [c for c in found if c.rows > mean and c.low < c.high]:
        wanted = [part for c in heavy for part in _cut(c, max(2, cells // len(heavy)))]
        answer = run(cells_sql(table, column, wanted)).collect()  # one row a cell
        light = [c for c in found if c not in heavy]
        found = sorted([*light, *(_Cell(math.floor(r["lo"]), math.ceil(r["hi"]), int(r["n"])) for r in answer)], key=lambda c: (c.low, c.high))
    bounds, counts, open_ = [], [], 0
    for c in found:
        # A range closes before a value of its own, and as soon as it holds the mean.
        if open_ and (open_ >= mean or open_ + c.rows > 2 * mean):
            bounds.append(c.low)
            counts.append(open_)
            open_ = 0
        open_ += c.rows
    return JdbcRanges(column, tuple(bounds), (*counts, open_), int(first["nulls"]))
