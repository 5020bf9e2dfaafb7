"""Sinks: Parquet (K1), JDBC (K2), CSV (K3), dated snapshots (K4), file-count
control (K5)."""

from mdmspark.sinks.files import SAVE_MODES, planned_files, save_mode, shape_files, size_files, write_csv, write_parquet, write_snapshot
from mdmspark.sinks.jdbc import jdbc_write_options, write_jdbc
from mdmspark.sinks.snapshots import ReconcileError, commit_snapshot, recover_snapshot

__all__ = [
    "SAVE_MODES",
    "ReconcileError",
    "commit_snapshot",
    "recover_snapshot",
    "planned_files",
    "save_mode",
    "size_files",
    "shape_files",
    "jdbc_write_options",
    "write_csv",
    "write_jdbc",
    "write_parquet",
    "write_snapshot",
]
