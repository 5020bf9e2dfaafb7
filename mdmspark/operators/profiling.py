"""Key profiling: duplicate keys (A2 + W3) and keys with several values
(A3, A4 + W4, W5).

A set of values per key is returned as rows ``(key, value, n_values)``, not
as an array: one key may hold a third of all rows, and an array would put
the whole group into one record. The distinct ``(key, value)`` pairs are
formed first by a hash aggregate with map-side combine, so the shuffles
carry distinct pairs only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """``(name, n_rows)`` for every non-NULL key on more than one row."""
    return (
        df.where(key.isNotNull())
        .groupBy(key.alias(name))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def value_conflicts(df: DataFrame, key: Column, value: Column,
                    key_name: str = "key", value_name: str = "value") -> DataFrame:
    """``(key_name, value_name, n_values)`` for each distinct non-NULL value of
    every key that has more than one (a NULL key is one group)."""
    pairs = (
        df.select(key.alias(key_name), value.alias(value_name))
        .where(F.col(value_name).isNotNull())
        .distinct()
    )
    counts = (
        pairs.groupBy(key_name)
        .agg(F.count(F.lit(1)).alias("n_values"))
        .where(F.col("n_values") > 1)
    )
    p, c = pairs.alias("p"), counts.alias("c")
    return p.join(c, F.col(f"p.{key_name}").eqNullSafe(F.col(f"c.{key_name}"))).select(
        F.col(f"p.{key_name}"), F.col(f"p.{value_name}"), F.col("c.n_values")
    )


def bounded_sets(df: DataFrame, key: Column, value: Column, most: int = 20, least: int = 1,
                 key_name: str = "key", value_name: str = "values") -> DataFrame:
    """``(key_name, n_values, value_name)`` for every key with at least ``least``
    distinct non-NULL values: their exact number, and the ``most`` smallest of
    them as a sorted array (A4 with its size, F8, for display).

    No array ever holds more than ``most`` values and no task a key's rows: the
    distinct pairs are counted by partial aggregates, and ranked after each task
    has cut them to ``most`` a key. Both use the exchange of the distinct pairs."""
    if most < 1:
        raise ValueError("most must be >= 1")
    pairs = df.select(key.alias("_k"), value.alias("_v")).where(F.col("_v").isNotNull()).distinct()
    counts = pairs.groupBy("_k").agg(F.count(F.lit(1)).alias("n_values")).where(F.col("n_values") >= least)
    place = F.row_number().over(Window.partitionBy("_k").orderBy("_v"))
    firsts = pairs.withColumn("_place", place).where(F.col("_place") <= most).groupBy("_k").agg(F.array_sort(F.collect_list("_v")).alias("_values"))
    c, f = counts.alias("c"), firsts.alias("f")
    joined = c.join(f, F.col("c._k").eqNullSafe(F.col("f._k")))
    return joined.select(F.col("c._k").alias(key_name), "n_values", F.col("_values").alias(value_name))
