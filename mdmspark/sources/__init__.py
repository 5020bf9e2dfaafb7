"""Sources: JDBC (S1-S4, S9), Parquet (S5, S6), CSV (S7, S8), dated
snapshots (S10)."""

from mdmspark.sources.files import (
    SNAPSHOT_COLUMN,
    parse_snapshot_date,
    read_csv,
    read_parquet,
    read_snapshot,
    read_snapshots,
    snapshot_path,
)
from mdmspark.sources.manifest import MANIFEST, Manifest, SnapshotError, Store, read_manifest
from mdmspark.sources.jdbc import (
    SOURCE_TABLES,
    JdbcPartitioning,
    extract_table,
    jdbc_options,
    jdbc_reader,
    partitioning_for,
    ranges_for,
    read_jdbc,
)
from mdmspark.sources.ranges import JdbcRanges, equi_depth_ranges

__all__ = [
    "MANIFEST",
    "Manifest",
    "SNAPSHOT_COLUMN",
    "SnapshotError",
    "Store",
    "read_manifest",
    "SOURCE_TABLES",
    "JdbcPartitioning",
    "JdbcRanges",
    "equi_depth_ranges",
    "extract_table",
    "jdbc_options",
    "jdbc_reader",
    "parse_snapshot_date",
    "partitioning_for",
    "ranges_for",
    "read_csv",
    "read_jdbc",
    "read_parquet",
    "read_snapshot",
    "read_snapshots",
    "snapshot_path",
]
