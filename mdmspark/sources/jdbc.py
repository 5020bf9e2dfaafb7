"""JDBC sources.

Connection settings are passed in as an options mapping (``url``, ``user``,
``password``, ``driver``, ...), never written in code.

A plain JDBC read is one partition: one task pulls the whole table through
one connection. For large tables pass :class:`JdbcRanges` (ranges of an integer
column with about equal counts, one connection each, see
:func:`ranges_for`) or :class:`JdbcPartitioning`, with which Spark
opens ``num_partitions`` connections, each reading one equally wide range of a
numeric, date or timestamp column. ``query`` cannot be combined with
``partitionColumn``, so a partitioned query is sent as ``dbtable="(sql) q"``.
Filters and column selections on the result are pushed into the SQL Spark
sends to the database.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.types import StructType

from mdmspark.sources.ranges import JdbcRanges, equi_depth_ranges

CONNECTION_KEYS = ("url", "user", "password", "driver")


@dataclass(frozen=True)
class JdbcPartitioning:
    column: str
    lower_bound: int | str
    upper_bound: int | str
    num_partitions: int


def jdbc_options(
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    custom_schema: StructType | str | None = None,
    partitioning: JdbcPartitioning | None = None,
    fetch_size: int | None = None,
) -> dict[str, str]:
    """The reader options for a whole table (S3) or the result of a SQL query
    (S2), on top of the connection ``options`` (S1).

    ``custom_schema`` gives column types to read as, as a schema or a DDL
    string, e.g. ``"id BIGINT, amount STRING"`` (S4); columns not named keep
    the types the database reports.
    """
    if "url" not in options:
        raise ValueError("JDBC options need a 'url'")
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    out = {k: str(v) for k, v in options.items() if v is not None}
    if partitioning is not None:
        if partitioning.num_partitions < 1:
            raise ValueError("num_partitions must be >= 1")
        out["dbtable"] = table if table is not None else f"({query}) q"
        out["partitionColumn"] = partitioning.column
        out["lowerBound"] = str(partitioning.lower_bound)
        out["upperBound"] = str(partitioning.upper_bound)
        out["numPartitions"] = str(partitioning.num_partitions)
    elif table is not None:
        out["dbtable"] = table
    else:
        out["query"] = query
    if isinstance(custom_schema, StructType):
        custom_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in custom_schema.fields)
    if custom_schema:
        out["customSchema"] = custom_schema
    if fetch_size:
        out["fetchsize"] = str(fetch_size)
    return out


def jdbc_reader(spark: SparkSession, options: Mapping[str, str]) -> DataFrameReader:
    """A JDBC reader with the connection options set."""
    if "url" not in options:
        raise ValueError("JDBC options need a 'url'")
    return spark.read.format("jdbc").options(**{k: str(v) for k, v in options.items() if v is not None})


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    custom_schema: StructType | str | None = None,
    partitioning: JdbcPartitioning | JdbcRanges | None = None,
    fetch_size: int | None = None,
) -> DataFrame:
    """Read a whole table (S3) or a query result (S2); see :func:`jdbc_options`.
    :class:`JdbcRanges` are sent as one condition a connection."""
    ranges = partitioning if isinstance(partitioning, JdbcRanges) else None
    opts = jdbc_options(options, table, query, custom_schema, None if ranges else partitioning, fetch_size)
    if ranges is None:
        return spark.read.format("jdbc").options(**opts).load()
    name = opts.pop("dbtable", None) or f"({opts.pop('query')}) q"
    return spark.read.jdbc(opts.pop("url"), name, predicates=ranges.predicates(), properties=opts)


def ranges_for(spark: SparkSession, options: Mapping[str, str], table: str, column: str, num_ranges: int) -> JdbcRanges:
    """Ranges of an integer ``column`` with about equal counts, counted by the
    database in a few aggregate queries over that column."""
    return equi_depth_ranges(lambda sql: read_jdbc(spark, options, query=sql), table, column, num_ranges)


def partitioning_for(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    column: str,
    num_partitions: int,
) -> JdbcPartitioning:
    """Range partitioning over ``column`` from its current bounds, read with
    one small aggregate query (one row comes back). Rows outside the bounds
    are still read: Spark's first and last ranges are open-ended."""
    q = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = read_jdbc(spark, options, query=q).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:  # empty table: one partition is enough
        return JdbcPartitioning(column, 0, 1, 1)
    return JdbcPartitioning(column, lo, hi, num_partitions)


# Source tables extracted by the staging jobs.
SOURCE_TABLES = {
    "transactions": "banking.transactions",
    "cards": "banking.cards",
    "mcc_codes": "banking.mcc_codes",
    "users": "banking.users",
}


# Columns whose ranges are read in parallel unless the caller says otherwise.
# The code list has no such column and at most 10,000 codes.
PARTITION_COLUMNS = {"transactions": "id", "cards": "id", "users": "id"}


def extract_table(
    spark: SparkSession,
    options: Mapping[str, str],
    name: str,
    partitioning: JdbcPartitioning | JdbcRanges | None = None,
    tables: Mapping[str, str] = SOURCE_TABLES,
) -> DataFrame:
    """Full extract of one source table, all columns as the database has them."""
    return read_jdbc(spark, options, table=tables[name], partitioning=partitioning)
