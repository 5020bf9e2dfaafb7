"""Staging (E1): extract a source table once and commit it as a dated Parquet
snapshot, reconciled before it replaces the date's old one (Q2).

The source is evaluated exactly once: row count and content fingerprint are
observed during the write itself (``DataFrame.observe``), not by a separate
job that would re-run the JDBC query (and could see a different table state
than the write). What was written is then read back, and only if its
fingerprint is the same does it take the place of the old snapshot (see
:mod:`mdmspark.sinks.snapshots`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mdmspark.operators.fingerprint import Fingerprint
from mdmspark.sinks.snapshots import ReconcileError, commit_snapshot
from mdmspark.sources.files import parse_snapshot_date, snapshot_path
from mdmspark.sources.jdbc import PARTITION_COLUMNS, SOURCE_TABLES, JdbcPartitioning, JdbcRanges, extract_table, ranges_for

__all__ = ["ReconcileError", "StageReport", "stage_from_jdbc", "stage_table"]


@dataclass(frozen=True)
class StageReport:
    table: str
    snapshot_date: dt.date
    path: str
    source_rows: int
    snapshot_rows: int
    fingerprint: Fingerprint | None = None


def stage_table(
    spark: SparkSession,
    source: DataFrame,
    table_root: str,
    snapshot_date: str | dt.date,
    table: str = "",
    files: int | None = None,
    control: Fingerprint | None = None,
) -> StageReport:
    """Commit ``source`` as the ``snapshot_date`` snapshot under ``table_root``
    (replacing only that date), if what was written reads back the same and
    agrees with ``control``, the totals the source gives, if any. Else
    :class:`ReconcileError`, and the date's old snapshot stays."""
    d = parse_snapshot_date(snapshot_date)
    try:
        done = commit_snapshot(spark, source, table_root, d, files=files, control=control)
    except ReconcileError as err:
        raise ReconcileError(f"{table}: {err}") from err
    return StageReport(table, d, snapshot_path(table_root, d), done.rows, done.rows, done.fingerprint)


def stage_from_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    stg_root: str,
    snapshot_date: str | dt.date,
    partitioning: JdbcPartitioning | JdbcRanges | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    single_connection: bool = False,
    source_table: str | None = None,
) -> StageReport:
    """Extract one of the source tables over JDBC (``source_table``: its name
    in the database) and stage it at ``stg_root/<table>``.

    Unless ``partitioning`` is given, ranges of about equal counts are taken of
    the integer ``partition_column`` (default: the table's id), one connection
    each, ``num_partitions`` in all (default: the session's default
    parallelism) and one for rows without it. For columns of other types give a
    :class:`JdbcPartitioning`. Only with ``single_connection`` does everything
    pass through one."""
    parse_snapshot_date(snapshot_date)
    tables = {**SOURCE_TABLES, **({table: source_table} if source_table else {})}
    column = partition_column or PARTITION_COLUMNS.get(table)
    if single_connection:
        partitioning = None
    elif partitioning is None and column:
        n = num_partitions or spark.sparkContext.defaultParallelism
        partitioning = ranges_for(spark, options, tables[table], column, n)
    source = extract_table(spark, options, table, partitioning=partitioning, tables=tables)
    return stage_table(spark, source, f"{stg_root.rstrip('/')}/{table}", snapshot_date, table=table)
