"""JDBC wiring without a database: the reader is replaced by frames built
from the test tables, so range derivation and staging from JDBC run end to
end; only the network call itself is not exercised."""

import mdmspark.plans.staging as staging
import mdmspark.sources.jdbc as jdbc
from conftest import SF001
from mdmspark.fixtures import fixture
from mdmspark.sources import JdbcPartitioning, JdbcRanges, read_snapshot

OPTIONS = {"url": "jdbc:test://nowhere/db", "user": "u", "password": "p", "driver": "D"}


def test_partitioning_for_reads_bounds(spark, monkeypatch):
    calls = []

    def fake_read(spark_, options, table=None, query=None, **kw):
        calls.append(query)
        return spark_.createDataFrame([(5, 99)], "lo bigint, hi bigint")

    monkeypatch.setattr(jdbc, "read_jdbc", fake_read)
    p = jdbc.partitioning_for(spark, OPTIONS, "banking.cards", "id", 8)
    assert p == JdbcPartitioning("id", 5, 99, 8)
    assert calls == ["SELECT MIN(id) AS lo, MAX(id) AS hi FROM banking.cards"]


def test_partitioning_for_empty_table(spark, monkeypatch):
    monkeypatch.setattr(jdbc, "read_jdbc",
                        lambda s, o, **kw: s.createDataFrame([(None, None)], "lo bigint, hi bigint"))
    assert jdbc.partitioning_for(spark, OPTIONS, "banking.cards", "id", 8).num_partitions == 1


def test_stage_from_jdbc(spark, monkeypatch, tmp_root):
    seen = {}

    def fake_extract(spark_, options, name, partitioning=None, **kw):
        seen["args"] = (name, partitioning)
        return fixture(spark_, SF001, "cards_src")

    monkeypatch.setattr(staging, "extract_table", fake_extract)
    monkeypatch.setattr(staging, "ranges_for", lambda s, o, table, column, n: JdbcRanges(column, (n,), (1, 1)))
    rep = staging.stage_from_jdbc(spark, OPTIONS, "cards", f"{tmp_root}/stg", "20240101", num_partitions=4)
    assert seen["args"] == ("cards", JdbcRanges("id", (4,), (1, 1)))
    assert rep.source_rows == rep.snapshot_rows == fixture(spark, SF001, "cards_src").count()
    assert read_snapshot(spark, f"{tmp_root}/stg/cards", "20240101").count() == rep.snapshot_rows


def test_one_connection_only_on_request(spark, monkeypatch, tmp_root):
    seen = []
    monkeypatch.setattr(staging, "extract_table", lambda s, o, name, partitioning=None, tables=None: (
        seen.append((tables[name], partitioning)), s.range(3))[1])
    monkeypatch.setattr(staging, "ranges_for", lambda s, o, table, column, n: JdbcRanges(column, (n,), (1, 1)))
    cores = spark.sparkContext.defaultParallelism
    for table, extra in (("transactions", {}), ("users", {"source_table": "crm.people"}), ("cards", {"single_connection": True}), ("mcc_codes", {})):
        staging.stage_from_jdbc(spark, OPTIONS, table, f"{tmp_root}/stg", "20240101", **extra)
    assert seen == [("banking.transactions", JdbcRanges("id", (cores,), (1, 1))), ("crm.people", JdbcRanges("id", (cores,), (1, 1))),
                    ("banking.cards", None), ("banking.mcc_codes", None)]


def test_schema_object(spark):
    schema = spark.createDataFrame([], "id bigint, amount decimal(18,2), note string").schema
    got = jdbc.jdbc_options(OPTIONS, table="t", custom_schema=schema)
    assert got["customSchema"] == "`id` bigint, `amount` decimal(18,2), `note` string"
