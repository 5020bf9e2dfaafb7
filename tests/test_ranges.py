"""Equi-depth ranges of a column, with the source replaced by frames."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import mdmspark.plans.staging as staging
import mdmspark.sources.jdbc as jdbc
from mdmspark.sources import JdbcRanges, equi_depth_ranges
from mdmspark.sources.ranges import cells_sql

OPTIONS = {"url": "jdbc:test://nowhere/db", "user": "u", "password": "p", "driver": "D"}


def ranges(spark, df, n, cells=512):
    queries = []

    def run(sql):
        queries.append(sql)
        return spark.sql(sql, src=df)

    return equi_depth_ranges(run, "{src}", "id", n, cells), queries


def read(df, found):
    """Rows of each condition, and how many conditions each row meets."""
    ps = found.predicates()
    counts = df.agg(*[F.count_if(F.expr(p)).alias(f"c{i}") for i, p in enumerate(ps)]).first()
    times = df.select(sum((F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in ps), F.lit(0)).alias("t")).distinct().collect()
    return list(counts), {r.t for r in times}


SKEWED = {
    "even": list(range(4000)),
    "one outlier": [*range(3000), 10**17],
    "outliers on both sides": [-(10**18), *range(500), *range(10**12, 10**12 + 2000), 9 * 10**18],
    "squares": [i * i for i in range(3000)],
    "powers": [2**i + k for i in range(60) for k in range(40)],
    "few": [1, 5, 9],
    "one": [7],
    "negative": list(range(-2000, 10)),
}


@pytest.mark.parametrize("name", list(SKEWED))
@pytest.mark.parametrize("n", [1, 8, 16])
def test_each_row_once_and_no_range_above_twice_the_mean(spark, name, n):
    rows = SKEWED[name]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i,) for i in rows] + [(None,)] * 3, "id long").coalesce(2)
    found, queries = ranges(spark, df, n)
    counts, times = read(df, found)
    assert times == {1} and counts[-1] == 3 == found.null_rows
    assert tuple(counts[:-1]) == found.counts or not found.bounds
    assert max(counts[:-1]) <= 2 * max(1, -(-len(rows) // n)) and len(counts) <= n + 1
    assert len(queries) <= 12


def test_a_few_cells_a_pass_do(spark):
    df = spark.createDataFrame([(i,) for i in SKEWED["outliers on both sides"]], "id long").coalesce(2)
    found, queries = ranges(spark, df, 8, cells=16)
    assert max(found.counts) <= 2 * 314 and all(q.count("WHEN") <= 32 for q in queries)


def test_a_value_with_most_rows_stands_alone(spark):
    df = spark.createDataFrame([(i,) for i in [*range(100), *[50] * 900]], "id long").coalesce(2)
    found, _ = ranges(spark, df, 10)
    counts, times = read(df, found)
    assert times == {1} and sorted(counts)[-1] == 901 and max(sorted(counts)[:-1]) <= 200


def test_rows_that_come_later_are_read(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)], "id long").coalesce(2)
    found, _ = ranges(spark, df, 4)
    later = spark.createDataFrame([(-5,), (None,), (10**15,), (500,)], "id long")
    assert read(later, found)[1] == {1}


def test_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "id long")
    found, queries = ranges(spark, df, 4)
    assert found == JdbcRanges("id", (), (), 2) and len(queries) == 1
    assert read(df, found) == ([0, 2], {1})
    assert ranges(spark, df.limit(0), 4)[0].null_rows == 0
    with pytest.raises(ValueError):
        equi_depth_ranges(None, "t", "id", 0)


class Answer(list):
    """What a source says: rows by name."""

    def first(self):
        return self[0]

    def collect(self):
        return self


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50), st.integers(-(10**18), 10**18)), max_size=200), st.integers(1, 20), st.integers(4, 40))
def test_any_ids(values, n, cells):
    import duckdb

    con = duckdb.connect()
    con.execute("create table t (id bigint)")
    if values:
        con.executemany("insert into t values (?)", [(v,) for v in values])
    def run(sql):
        got = con.execute(sql)
        names = [c[0] for c in got.description]
        return Answer(dict(zip(names, r)) for r in got.fetchall())
    found = equi_depth_ranges(run, "t", "id", n, cells)
    sums = [con.execute(f"select count(*) from t where {p}").fetchone()[0] for p in found.predicates()]
    assert sum(sums) == len(values)
    mean, top = max(1, -(-len(values) // n)), max((values.count(v) for v in set(values)), default=0)
    assert max(sums) <= max(2 * mean, top)


def test_ranges_are_sent_as_conditions(spark, monkeypatch):
    sent = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            sent.update(url=url, table=table, predicates=predicates, properties=properties)
            return "frame"

    class Session:
        read = Reader()

    found = JdbcRanges("id", (10, 20), (5, 5, 5), 1)
    assert jdbc.read_jdbc(Session(), OPTIONS, table="banking.cards", partitioning=found, fetch_size=9) == "frame"
    assert sent["predicates"] == ["id < 10", "id >= 10 AND id < 20", "id >= 20", "id IS NULL"] and sent["table"] == "banking.cards"
    assert sent["url"] == OPTIONS["url"] and sent["properties"] == {"user": "u", "password": "p", "driver": "D", "fetchsize": "9"}
    jdbc.read_jdbc(Session(), OPTIONS, query="select 1 as id", partitioning=found)
    assert sent["table"] == "(select 1 as id) q" and "query" not in sent["properties"]


def test_staging_counts_its_ranges_in_the_source(spark, monkeypatch, tmp_root):
    df = spark.createDataFrame([(i * i,) for i in range(900)], "id long").coalesce(2)
    monkeypatch.setattr(jdbc, "read_jdbc", lambda s, o, query=None, **k: s.sql(query.replace("banking.users", "{src}"), src=df))
    seen = []
    monkeypatch.setattr(staging, "extract_table", lambda s, o, name, partitioning=None, tables=None: (seen.append(partitioning), df)[1])
    rep = staging.stage_from_jdbc(spark, OPTIONS, "users", f"{tmp_root}/stg", "20240101", num_partitions=6)
    assert rep.snapshot_rows == 900 and sum(seen[0].counts) == 900 and max(seen[0].counts) <= 300


def test_the_first_query_asks_for_no_cells():
    assert cells_sql("t", "id", []) == "SELECT 0 AS cell, COUNT(id) AS n, MIN(id) AS lo, MAX(id) AS hi, COUNT(*) - COUNT(id) AS nulls FROM t"
