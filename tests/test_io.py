"""Sources and sinks: save modes, CSV and Parquet round trips, dated
snapshots with dynamic overwrite, JDBC option building."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from mdmspark.sinks import jdbc_write_options, save_mode, write_csv, write_parquet, write_snapshot
from mdmspark.sources import (
    JdbcPartitioning,
    jdbc_options,
    parse_snapshot_date,
    read_csv,
    read_parquet,
    read_snapshot,
    read_snapshots,
)


def test_save_mode():
    assert save_mode(" Overwrite ") == "overwrite"
    assert save_mode("ErrorIfExists") == "errorifexists"
    with pytest.raises(ValueError):
        save_mode("upsert")


def test_snapshot_date():
    assert parse_snapshot_date("20240229") == dt.date(2024, 2, 29)
    for bad in ("2024111", "2024-11-01", "20240230", "2024113a"):
        with pytest.raises(ValueError):
            parse_snapshot_date(bad)


def test_parquet_modes(spark, tmp_root):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    path = f"{tmp_root}/p"
    write_parquet(df, path)
    write_parquet(df, path, mode="append")
    assert read_parquet(spark, path).count() == 2
    write_parquet(df, path, mode="ignore")
    assert read_parquet(spark, path).count() == 2
    with pytest.raises(AnalysisException):
        write_parquet(df, path, mode="error")
    write_parquet(df, path, mode="overwrite", files=1)
    assert read_parquet(spark, path, schema="id int").columns == ["id"]


def test_csv_round_trip_keeps_nulls_blanks_and_header(spark, tmp_root):
    df = spark.createDataFrame([(1, ""), (2, None), (None, " a "), (4, 'x"y,z')], "id int, s string")
    path = f"{tmp_root}/c"
    write_csv(df, path)
    back = read_csv(spark, path, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    inferred = read_csv(spark, path)
    assert inferred.count() == 4


def test_snapshot_dynamic_overwrite(spark, tmp_root):
    root = f"{tmp_root}/snap"
    a = spark.createDataFrame([(1,), (2,)], "id int")
    b = spark.createDataFrame([(3,)], "id int")
    write_snapshot(a, root, "20240101")
    write_snapshot(a, root, "20240102")
    write_snapshot(b, root, "20240101")
    assert sorted(r.id for r in read_snapshot(spark, root, "20240101").collect()) == [3]
    assert sorted(r.id for r in read_snapshot(spark, root, "20240102").collect()) == [1, 2]
    assert read_snapshot(spark, root, "20240102").columns == ["id", "snapshot_date"]
    every = read_snapshots(spark, root)
    assert every.where(F.col("snapshot_date") == F.lit(dt.date(2024, 1, 2))).count() == 2
    with pytest.raises(AnalysisException):
        read_snapshot(spark, root, "20240103").count()


def test_snapshot_read_prunes(spark, tmp_root):
    root = f"{tmp_root}/snap2"
    write_snapshot(spark.createDataFrame([(1, "a")], "id int, v string"), root, "20240101")
    plan = read_snapshots(spark, root).where(F.col("snapshot_date") == F.lit(dt.date(2024, 1, 1))).select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
    assert "ReadSchema: struct<id:int>" in text


def test_jdbc_options():
    conn = {"url": "jdbc:x://h/db", "user": "u", "password": None, "driver": "D"}
    assert jdbc_options(conn, table="banking.cards") == {"url": "jdbc:x://h/db", "user": "u", "driver": "D",
                                                         "dbtable": "banking.cards"}
    q = jdbc_options(conn, query="select 1", custom_schema="id BIGINT", fetch_size=1000)
    assert q["query"] == "select 1" and q["customSchema"] == "id BIGINT" and q["fetchsize"] == "1000"
    p = jdbc_options(conn, query="select * from t", partitioning=JdbcPartitioning("id", 0, 100, 4))
    assert p["dbtable"] == "(select * from t) q" and "query" not in p
    assert (p["partitionColumn"], p["lowerBound"], p["upperBound"], p["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_options(conn, table="a", query="b")
    with pytest.raises(ValueError):
        jdbc_options({"user": "u"}, table="a")
    w = jdbc_write_options(conn, "out", truncate=True, batch_size=500, num_partitions=8)
    assert (w["dbtable"], w["truncate"], w["batchsize"], w["numPartitions"]) == ("out", "true", "500", "8")


def test_empty_result_replaces_the_date(spark, tmp_root):
    root = f"{tmp_root}/empty"
    full = spark.createDataFrame([(1,), (2,)], "id int")
    assert write_snapshot(full, root, "20240101") == 2
    assert write_snapshot(full, root, "20240102") == 2
    assert write_snapshot(full.where("id > 5"), root, "20240101") == 0
    assert read_snapshot(spark, root, "20240101").count() == 0
    assert read_snapshot(spark, root, "20240101").columns == ["id", "snapshot_date"]
    assert read_snapshot(spark, root, "20240102").count() == 2


def test_csv_keeps_newlines_quotes_and_backslashes(spark, tmp_root):
    rows = [(1, "a\nb"), (2, "\r\n"), (3, 'say "x", "y"'), (4, "back\\"), (5, '\\"'), (6, ""), (7, None), (8, " , ")]
    df = spark.createDataFrame(rows, "id int, s string")
    write_csv(df, f"{tmp_root}/q", files=2)
    assert sorted(map(tuple, read_csv(spark, f"{tmp_root}/q", schema=df.schema).collect()), key=repr) == sorted(rows, key=repr)


def test_csv_refuses_its_null_marker(spark, tmp_root):
    df = spark.createDataFrame([(1, "\u0000")], "id int, s string")
    with pytest.raises(Exception, match="U\\+0000"):
        write_csv(df, f"{tmp_root}/z")


def test_line_safe_csv_keeps_every_text(spark, tmp_root):
    texts = ["a\nb", "\r\n", '"', '"\n"', "back\\slash\\n", "\\", "", None, "  x  ", "%0A", "%", "%250A", "100%\n%0D%00", "\u0000", "a\u0000b", "a,b", "'", "  \u0085", "é漢\n🙂", "%%25"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1)
    write_csv(df, tmp_root, safe_lines=True)
    for schema in ("id int, t string", None):
        assert {r.id: r.t for r in read_csv(spark, tmp_root, schema=schema, safe_lines=True).collect()} == dict(enumerate(texts))


def test_line_safe_csv_is_read_by_several_tasks(spark, tmp_root):
    df = spark.range(20_000).select("id", F.concat(F.lit("line one of "), F.col("id"), F.lit('\nand "two", 5 %\r\n')).alias("t"))
    write_csv(df.coalesce(1), tmp_root, safe_lines=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = read_csv(spark, tmp_root, schema="id long, t string", safe_lines=True)
        parts = back.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 4 and sum(r["count"] for r in parts) == 20_000
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
