"""File sinks (K1, K3, K4, K5).

No sink funnels the data through one task: the reference's ``coalesce(1)``
collapses the whole final stage (projection, or the de-duplication's reduce
side) into a single task. Here a write keeps the parallelism of its plan;
AQE sizes post-shuffle partitions, map-only writes keep one file per input
split, and ``max_records_per_file`` bounds file size. Where the source's size is
known (from its manifest), :func:`size_files` deals a frame of badly sized splits
anew. ``files=n`` asks for
about ``n`` files via a round-robin repartition (an extra shuffle, so only
when a reader needs few files).
"""

from __future__ import annotations

import datetime as dt
import math
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mdmspark.sources.files import CSV_NULL, SNAPSHOT_COLUMN, line_safe, parse_snapshot_date, snapshot_path, text_columns

# Bytes that a file should have, and by how much the number of splits may differ from the one planned.
FILE_BYTES, SLACK = 256 << 20, 4

SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def save_mode(mode: str) -> str:
    """Validated save mode: lower-cased and trimmed; one of SAVE_MODES."""
    m = str(mode).strip().lower()
    if m not in SAVE_MODES:
        raise ValueError(f"invalid save mode {mode!r}; expected one of {SAVE_MODES}")
    return m


def shape_files(df: DataFrame, files: int | None = None) -> DataFrame:
    """Output file-count control (K5)."""
    if files is None:
        return df
    if files < 1:
        raise ValueError("files must be >= 1")
    return df.repartition(files)


def planned_files(total_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    """How many files of about ``file_bytes`` hold so many bytes; two at least,
    so that no write is a single task."""
    if file_bytes < 1:
        raise ValueError("file_bytes must be >= 1")
    return max(2, math.ceil(total_bytes / file_bytes))


def size_files(df: DataFrame, total_bytes: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``df`` in about as many partitions as files are planned for it, from the
    known size of its source (K5). A frame whose splits are within a factor of
    :data:`SLACK` of that stays as it is, so a map-only write remains one; many
    tiny splits, or a few very large ones, are dealt anew, rows evenly."""
    wanted = planned_files(total_bytes, file_bytes)
    splits = df.rdd.getNumPartitions()  # planned on the driver, no job
    return df if wanted / SLACK <= splits <= wanted * SLACK else df.repartition(wanted)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Parquet write with a validated save mode (K1)."""
    w = shape_files(df, files).write.mode(save_mode(mode))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              files: int | None = None, safe_lines: bool = False) -> None:
    """CSV write with a header line (K3), so a read with ``header=True`` does
    not lose the first row. Surrounding spaces are kept; NULL is an empty
    field and the empty string is written quoted (""), so a read by
    :func:`mdmspark.sources.files.read_csv` tells them apart. Quotes are
    doubled (a backslash is an ordinary character) and newlines stay inside
    their quoted field. The one text that cannot be written is a lone U+0000,
    the reader's NULL marker: it raises. With ``safe_lines`` line ends, U+0000
    and ``%`` are written as ``%0A``, ``%0D``, ``%00`` and ``%25``: every record is
    one line, so a reader with the same option can split files, and nothing raises."""
    df = text_columns(df, line_safe) if safe_lines else df
    marked = {
        f.name: F.when(F.col(f"`{f.name}`") == CSV_NULL, F.raise_error(F.lit(f"column {f.name} holds a lone U+0000"))).otherwise(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if f.dataType.simpleString() == "string"
    }
    (
        shape_files(df.withColumns(marked) if marked else df, files).write.mode(save_mode(mode))
        .option("header", header)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_snapshot(df: DataFrame, root: str, snapshot_date: str | dt.date, files: int | None = None,
                   max_records_per_file: int | None = None) -> int:
    """Idempotent dated snapshot (K4): writes ``root/snapshot_date=YYYY-MM-DD``
    and replaces only that date; other dates stay untouched (dynamic partition
    overwrite, set on this write only). Re-running a date gives the same
    table. Task retries and lost executors are handled by Spark's commit
    protocol: only committed task outputs become visible, and the old files
    of the date are replaced only when the job commits.

    Returns the number of rows written, observed during the write (no second
    job). Dynamic overwrite replaces only dates that receive rows, so an empty
    result is written as an empty snapshot of the date explicitly."""
    d = parse_snapshot_date(snapshot_date)
    obs = Observation(f"snapshot_{uuid.uuid4().hex}")
    # Observed before the constant partition column is added: Catalyst then sees
    # that the column is constant and the writer asks for no sort by it.
    out = shape_files(df.drop(SNAPSHOT_COLUMN), files).observe(obs, F.count(F.lit(1)).alias("rows"))
    out = out.withColumn(SNAPSHOT_COLUMN, F.lit(d))
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT_COLUMN)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(root)
    rows = int(obs.get["rows"])
    if rows == 0:
        df.drop(SNAPSHOT_COLUMN).limit(0).write.mode("overwrite").parquet(snapshot_path(root, d))
    return rows
