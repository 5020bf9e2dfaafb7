"""File sources."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from mdmspark.functions.constants import SNAPSHOT_DATE_PATTERN
from mdmspark.sources.manifest import SnapshotError, Store, check_files, check_schema, read_manifest

SNAPSHOT_COLUMN = "snapshot_date"
# What the CSV reader puts for an unquoted empty field; never a written value.
CSV_NULL = "\u0000"


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet with the footer schema (S5) or a declared one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


# What line-safe CSV puts for characters that would end a line or stand for
# NULL, and for the sign that begins these forms: that one last when reading.
LINE_SAFE = (("\n", "%0A"), ("\r", "%0D"), ("\u0000", "%00"), ("%", "%25"))


def line_safe(text: Column) -> Column:
    """Text without line ends; :func:`from_line_safe` gives it back. As every
    ``%`` of the result begins one of the forms, no form arises by chance."""
    for raw, form in reversed(LINE_SAFE):
        text = F.replace(text, F.lit(raw), F.lit(form))
    return text


def from_line_safe(text: Column) -> Column:
    for raw, form in LINE_SAFE:
        text = F.replace(text, F.lit(form), F.lit(raw))
    return text


def text_columns(df: DataFrame, form: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``form`` applied to its string columns."""
    names = {f.name: f"`{f.name.replace('`', '``')}`" for f in df.schema.fields}
    return df.select(*[(form(F.col(q)) if isinstance(df.schema[n].dataType, StringType) else F.col(q)).alias(n) for n, q in names.items()])


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = True, safe_lines: bool = False) -> DataFrame:
    """CSV with a header line. With ``schema`` (S8) values are read as
    declared; without (S7) types are inferred, which costs an extra pass and
    turns codes such as '0742' into 742, so prefer a schema. Surrounding
    spaces are kept, and an unquoted empty field is NULL while a quoted one
    ("") is the empty string, as written by
    :func:`mdmspark.sinks.files.write_csv`. Records may span lines, so a file
    is one split: write large tables as many files, or with ``safe_lines`` (in
    the sink as well), where values hold no line ends: any file is then read in
    splits, by as many tasks as its size asks for. ``multi_line=False`` reads
    other files without newlines in values in splits."""
    multi_line = multi_line and not safe_lines
    reader = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        # The parser hands back this marker for an unquoted empty field and ""
        # for a quoted one; only the marker is read as NULL.
        .option("nullValue", CSV_NULL)
        .option("emptyValue", "")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    df = reader.csv(path)
    return text_columns(df, from_line_safe) if safe_lines else df


def parse_snapshot_date(value: str | dt.date) -> dt.date:
    """A snapshot date from 'YYYYMMDD' (Q16): exactly eight digits forming a
    real calendar date. Raises ``ValueError`` otherwise."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value)
    if not re.fullmatch(SNAPSHOT_DATE_PATTERN, text):
        raise ValueError(f"snapshot date must be YYYYMMDD, got {value!r}")
    return dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))


def snapshot_path(root: str, snapshot_date: str | dt.date) -> str:
    d = parse_snapshot_date(snapshot_date)
    return f"{root.rstrip('/')}/{SNAPSHOT_COLUMN}={d.isoformat()}"


def read_snapshot(
    spark: SparkSession,
    root: str,
    snapshot_date: str | dt.date,
    schema: StructType | str | None = None,
    need_manifest: bool = False,
) -> DataFrame:
    """One dated snapshot of a table.

    Only that date's directory is listed and read (a read of the root plus a
    filter would list every date first); ``basePath`` keeps the
    ``snapshot_date`` column. A missing snapshot raises ``AnalysisException``
    (Q17).

    A snapshot with a manifest (see :mod:`mdmspark.sinks.snapshots`) is checked
    before anything is read: a missing, unknown or resized file and a declared
    column of another type raise ``SnapshotError``; its schema comes from the
    manifest, so planning the read runs no job. One without is read as it is,
    or refused with ``need_manifest``.
    """
    path = snapshot_path(root, snapshot_date)
    store = Store(spark, root)
    manifest = read_manifest(store, path)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if manifest is not None:
        check_files(store, path, manifest)
        if declared is not None:
            check_schema(path, manifest, StructType([f for f in declared.fields if f.name != SNAPSHOT_COLUMN]))
        declared = declared or manifest.schema
    elif need_manifest and store.exists(path):
        raise SnapshotError(f"{path}: no manifest, so the snapshot may be half written")
    reader = spark.read.option("basePath", root)
    if declared is not None:
        reader = reader.schema(declared)
    return reader.parquet(path)


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """All dates of a snapshot table; filter on ``snapshot_date`` to prune."""
    return spark.read.parquet(root)
