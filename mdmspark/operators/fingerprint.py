"""Order-independent fingerprint of a table's content (Q2).

A row count cannot see a cut, shifted or swapped value. Here every row, and
every column on its own, is hashed (md5 over a text that is unambiguous about
NULL and value boundaries), and the hashes are summed: the sums do not depend on
the order or partitioning of the rows, and unlike an exclusive or they tell how
often a row occurs. Rows count twice 60 bits, columns 60 bits each, kept as
sums of 20-bit words, so a long holds the sum of 8 * 10^12 rows.

md5 is what any source can compute, so these sums are the ones to keep and to
hold against a source's. A sum of words is a sum over their hex digits: each task
adds its rows' digits up place by place, and none is turned into a number by
itself. Whether rows were written as they were is told by sums of as many bits of
xxhash64 over the same texts (``checks``), which also can be observed while they
are written; one scan of what was written gives both.

The sums of a whole row change when two rows swap a value; those of the columns
then do not, and in all other cases name the column.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType

from mdmspark.session import map_arrow, spread

ROW = "*"
_WORD = (1 << 20) - 1
# Hex digits in 60 bits, and in a word.
_HALF, _DIGITS = 15, 5


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    parts: Mapping[str, str]
    """sums of the words, joined by ``-``, of whole rows (:data:`ROW`) and of each column"""
    checks: Mapping[str, str] | None = field(default=None, compare=False)
    """the same of xxhash64, if they were taken"""

    def differences(self, other: Fingerprint) -> list[str]:
        """What tells the two apart, rows first; empty if nothing does."""
        out = [f"{self.rows} rows, {other.rows} rows"] if self.rows != other.rows else []
        out += [f"only one side has column {c}" for c in sorted(set(self.parts) ^ set(other.parts))]
        changed = [c for c in self.parts if c in other.parts and self.parts[c] != other.parts[c]]
        if changed == [ROW]:
            out.append("values were exchanged between rows")
        return out + [f"column {c} differs" for c in changed if c != ROW]

    def checked(self) -> Fingerprint:
        """The one whose parts are the ``checks``, as :func:`from_metrics` gives it."""
        return Fingerprint(self.rows, self.checks)


def _value(column: Column, kind: DataType) -> Column:
    text = F.hex(column) if isinstance(kind, BinaryType) else column.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A row as one text, unambiguous about NULL and where values end."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = [_value(F.col("`" + c.replace("`", "``") + "`"), kinds[c]) for c in (df.columns if columns is None else columns)]
    return F.concat(*values) if values else F.lit("")


def _words(text: Column, twice: bool) -> list[Column]:
    digest = F.md5(text)
    halves = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in ((1, 16) if twice else (1,))]
    return [F.shiftright(h, shift).bitwiseAND(F.lit(_WORD)) for h in halves for shift in (0, 20, 40)]


def _sums(df: DataFrame, names: Sequence[str]) -> dict[str, list[Column]]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = {c: _value(F.col("`" + c.replace("`", "``") + "`"), kinds[c]) for c in names}
    words = {ROW: _words(row_text(df, names), True), **{c: _words(v, False) for c, v in values.items()}}
    return {part: [F.coalesce(F.sum(w), F.lit(0).cast("long")) for w in ws] for part, ws in words.items()}


def _values(df: DataFrame, names: Sequence[str]) -> list[Column]:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return [_value(F.col("`" + c.replace("`", "``") + "`"), kinds[c]) for c in names]


def _check_hashes(values: Sequence[Column]) -> list[Column]:
    """Twice for whole rows, then of each value: of their bytes, whatever the collation. A value's text tells where it
    ends, so rows are hashed value by value."""
    values = [v.cast("binary") for v in values]
    return [F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values), *[F.xxhash64(v) for v in values]]


def _names(n: int, kind: str) -> list[str]:
    """Of the sums for ``n`` columns: six for whole rows, three for each."""
    return [f"{kind}{i}_{k}" for i in range(n + 1) for k in range(3 if i else 6)]


def check_aggregates(df: DataFrame) -> list[Column]:
    """The aggregates to observe; :func:`from_metrics` reads their values."""
    hashes = _check_hashes(_values(df, df.columns))
    words = [F.shiftright(h, shift).bitwiseAND(F.lit(_WORD)) for h in hashes for shift in (0, 20, 40)]
    sums = [F.coalesce(F.sum(w), F.lit(0).cast("long")).alias(name) for w, name in zip(words, _names(len(df.columns), "c"))]
    return [F.count(F.lit(1)).alias("rows"), *sums]


def from_metrics(metrics: Mapping[str, int], columns: Sequence[str], kind: str = "c") -> Fingerprint:
    parts = {}
    for i, part in enumerate([ROW, *columns]):
        parts[part] = "-".join(str(metrics[f"{kind}{i}_{k}"]) for k in range(6 if part == ROW else 3))
    return Fingerprint(int(metrics["rows"]), parts)


def _task_sums(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row: the sums of all rows of the task."""
        halves = n + 2
        rows, places, checks = 0, np.zeros(halves * _HALF, np.int64), np.zeros((halves, 3), np.int64)
        for b in batches:
            text = b.column("digits").cast(pa.binary(halves * _HALF))
            digits = np.frombuffer(text.buffers()[1], np.uint8)[text.offset * text.type.byte_width :][: len(text) * text.type.byte_width]
            digits = digits.reshape(len(text), text.type.byte_width)
            places += ((digits & 15) + 9 * (digits >> 6)).sum(axis=0, dtype=np.int64)
            for i in range(halves):
                hashed = b.column(f"h{i}").to_numpy()
                for k, shift in enumerate((0, 20, 40)):
                    checks[i, k] += ((hashed >> shift) & _WORD).sum()
            rows += len(text)
        words = places.reshape(halves, 3, _DIGITS) @ (16 ** np.arange(_DIGITS - 1, -1, -1))
        sums = [rows, *words[:, ::-1].ravel().tolist(), *checks.ravel().tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in sums], names=["rows", *_names(n, "p"), *_names(n, "c")])

    return run


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> Fingerprint:
    """The fingerprint of a frame, with its checks: one scan, one row to the driver."""
    names = list(df.columns if columns is None else columns)
    n = len(names)
    texts = spread(df).select(*[v.alias(f"v{i}") for i, v in enumerate(_values(df, names))])
    values = [F.col(c) for c in texts.columns]
    row = F.concat(*values) if values else F.lit("")
    digits = F.concat(F.substring(F.md5(row), 1, 2 * _HALF), *[F.substring(F.md5(v), 1, _HALF) for v in values])
    hashed = texts.select(digits.alias("digits"), *[h.alias(f"h{i}") for i, h in enumerate(_check_hashes(values))])
    sums = ["rows", *_names(n, "p"), *_names(n, "c")]
    added = map_arrow(hashed, _task_sums(n), ", ".join(f"{s} long" for s in sums))
    metrics = added.agg(*[F.coalesce(F.sum(s), F.lit(0).cast("long")).alias(s) for s in sums]).first().asDict()
    found, checks = from_metrics(metrics, names, "p"), from_metrics(metrics, names, "c")
    return Fingerprint(found.rows, found.parts, checks.parts)


def fingerprint_table(df: DataFrame) -> DataFrame:
    """The same as rows (part, n_rows, digest), one for whole rows and one for each column. Lazy."""
    sums = _sums(df, df.columns)
    digests = [F.struct(F.lit(part).alias("part"), F.concat_ws("-", *[s.cast("string") for s in ws]).alias("digest")) for part, ws in sums.items()]
    one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.array(*digests).alias("d"))
    return one.select("n_rows", F.explode("d").alias("d")).select("d.part", "n_rows", "d.digest")
