"""JDBC sink (K2).

Writes run one connection per partition; ``num_partitions`` caps the number
of concurrent connections (Spark coalesces down to it) so a large frame does
not open thousands of connections against one database.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from mdmspark.sinks.files import save_mode


def jdbc_write_options(
    options: Mapping[str, str],
    table: str,
    truncate: bool = False,
    batch_size: int | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Writer options on top of the connection ``options``."""
    if "url" not in options:
        raise ValueError("JDBC options need a 'url'")
    out = {k: str(v) for k, v in options.items() if v is not None}
    out["dbtable"] = table
    if truncate:
        out["truncate"] = "true"
    if batch_size:
        out["batchsize"] = str(batch_size)
    if num_partitions:
        out["numPartitions"] = str(num_partitions)
    return out


def write_jdbc(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    mode: str = "append",
    truncate: bool = False,
    batch_size: int | None = None,
    num_partitions: int | None = None,
) -> None:
    """Write ``df`` to ``table``. With ``mode='overwrite'`` and ``truncate``
    the table is emptied and kept (its DDL and grants survive) instead of
    dropped and re-created."""
    opts = jdbc_write_options(options, table, truncate, batch_size, num_partitions)
    df.write.format("jdbc").mode(save_mode(mode)).options(**opts).save()
