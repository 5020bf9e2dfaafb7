"""A key holding a third of all rows: results stay whole and every shuffle
on that key is preceded by a partial aggregate (the hot key reaches its
reducer as one row per map task)."""

import re

from pyspark.sql import functions as F

from mdmspark.operators import KeyRule, Rule, dedup, quality_metrics, value_conflicts
from mdmspark.plans import merchant


def hot(spark, n=30000):
    return spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 11).cast("string").alias("v"),
    )


def partial_before_every_exchange(df, fn_pattern):
    plan = df._jdf.queryExecution().executedPlan().toString()
    exchanges = len(re.findall(r"Exchange hashpartitioning", plan))
    partials = len(re.findall(fn_pattern, plan))
    return exchanges, partials


def test_dedup_hot_key(spark):
    out = dedup(hot(spark), "k")
    assert out.where("k = 7").collect()[0].v == "0"
    assert out.count() == 20000  # 10,000 rows fold into key 7 (id 7 is also 7)
    ex, partial = partial_before_every_exchange(out, r"partial_min")
    assert ex == 1 and partial >= 1


def test_metrics_hot_key(spark):
    df = hot(spark)
    m = quality_metrics(df, [Rule("v_zero", F.col("v") == "0")], F.col("k"),
                        [KeyRule("dup", "duplicate"), KeyRule("multi", "conflict", F.col("v"))])
    row = m.first().asDict()
    assert row == {"n_rows": 30000, "n_keys": 20000, "v_zero": 2728, "dup": 1, "multi": 1}
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_conflicts_hot_key_are_rows(spark):
    out = value_conflicts(hot(spark), F.col("k"), F.col("v"), "k", "v")
    rows = out.collect()
    assert {r.k for r in rows} == {7} and len(rows) == 11 and {r.n_values for r in rows} == {11}


def test_summary_hot_merchant(spark):
    rows = spark.range(30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("merchant_id"),
        F.lit("Paris").alias("merchant_city"),
        F.lit(None).cast("string").alias("merchant_state"),
        F.lit("10001").alias("zip"),
        F.when(F.col("id") % 2 == 0, "Chip Transaction").otherwise("Online Transaction").alias("use_chip"),
    )
    summ = merchant.ENTITY.summary(rows)
    plan = summ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan
    assert merchant.ENTITY.summary_metrics(summ).first().asDict() == merchant.ENTITY.metrics(rows).first().asDict()
    a = sorted(map(tuple, merchant.ENTITY.build(rows).drop("etl_date").collect()))
    b = sorted(map(tuple, merchant.ENTITY.build_from_summary(summ).drop("etl_date").collect()))
    assert a == b and len(a) == 50
