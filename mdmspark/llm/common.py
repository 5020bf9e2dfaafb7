"""Small helpers shared by the text operators.

Conventions that hold in every operator:

* only the named input columns are read (``select`` first), so extra columns,
  whatever their names, never clash with computed ones;
* intermediate tables are written under the folder in
  ``spark.checkpoint.dir`` (see :func:`mdmspark.session.scratch_path`), so a
  lost executor costs a re-read, not a recomputation of everything before;
* Python work is cut into slices of bounded text, never whole partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdmspark.session import map_arrow, scratch_path

# Text held at a time by one Python task (UTF-8 bytes; a longer text is a slice of its own).
SLICE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a fresh path in the shared folder and read it back:
    cuts the lineage, fixes partition-dependent values, computes once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose ``text`` column holds about
    ``limit`` bytes; every row is in exactly one slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def ascii_lower(column: str = "text"):
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running_totals(df: DataFrame, order: list[str], values: dict[str, str], name: str) -> DataFrame:
    """``df`` with exclusive running totals (``values``: new column -> long
    column) over the total order ``order``, as a written table.

    A global window would pull all rows into one task. Here the rows are dealt
    by ranges of the order (a key with many rows is split as far as ``order``
    tells its rows apart), each task sums its own range, and only one total per
    range (as many rows as partitions) is added up before they are joined back.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"{_ddl(df)}, _range int" + "".join(f", {c} long" for c in values)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), dict.fromkeys(values, 0)
        for b in batches:
            cols = [b.column(i) for i in range(b.num_columns)] + [pa.array(np.full(b.num_rows, part, np.int32))]
            for c, source in values.items():
                v = pc.fill_null(b.column(source), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(v) + total[c]
                cols.append(pa.array(ends - v))
                if len(v):
                    total[c] = int(ends[-1])
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names, "_range", *values])

    local = materialize(map_arrow(ranged, within, schema), f"{name}-ranges")
    sums = local.groupBy("_range").agg(*[F.sum(s).alias(c) for c, s in values.items()]).collect()
    at, offsets = dict.fromkeys(values, 0), []
    for row in sorted(sums, key=lambda r: r["_range"]):  # one row per partition
        offsets.append((row["_range"], *at.values()))
        at = {c: at[c] + (row[c] or 0) for c in values}
    table = spark.createDataFrame(offsets or [(0, *at.values())], "_range int" + "".join(f", _{c} long" for c in values))
    out = local.join(F.broadcast(table), "_range")
    return out.select(*df.columns, *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in values])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
