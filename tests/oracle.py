"""Side-by-side check of ``queries()`` against ``oracle_sql()`` in DuckDB:
row count, column names and types, and an order-insensitive hash of the
values (columns sorted by name)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NaN"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_canon(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), h


def _spark_kind(t) -> str:
    n = t.simpleString()
    if n in ("bigint", "int", "smallint", "tinyint"):
        return "int:" + n
    return n


_DUCK = {"BIGINT": "int:bigint", "INTEGER": "int:int", "VARCHAR": "string", "DATE": "date",
         "TIMESTAMP": "timestamp", "BOOLEAN": "boolean", "DOUBLE": "double", "HUGEINT": "hugeint"}


def _duck_kind(t: str) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _DUCK.get(t, t)


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_types = {f.name: _spark_kind(f.dataType) for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: _duck_kind(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    sn, sh = digest(s_cols, s_rows)
    dn, dh = digest(d_cols, d_rows)
    return {
        "name": name,
        "rows": (sn, dn),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "types_match": s_types == d_types,
        "types": None if s_types == d_types else {c: (s_types.get(c), d_types.get(c))
                                                    for c in set(s_types) | set(d_types)
                                                    if s_types.get(c) != d_types.get(c)},
        "hash_match": sh == dh,
    }
