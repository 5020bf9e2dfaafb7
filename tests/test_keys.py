"""Surrogate-key goldens (the hash has no DuckDB twin, so its values are
pinned here)."""

from pyspark.sql import functions as F

from mdmspark.functions import merchant_key, natural_key_text, surrogate_key

GOLDENS = [
    ("43293||Beulah||ND||58523.0", 2360488786744616875),
    ("67570||ONLINE||||", 7685775026189571555),
    ("1||Paris||||", 5381890532797450292),
    ("1||A||B||1", 1279462342994911848),
    ("||||||", 5918543378800215651),
]


def test_goldens_from_text(spark, ansi):
    df = spark.createDataFrame([(t,) for t, _ in GOLDENS], "t string")
    got = [r[0] for r in df.select(surrogate_key(F.col("t")).alias("k")).collect()]
    assert got == [k for _, k in GOLDENS]


def test_goldens_from_parts(spark, ansi):
    rows = [(43293, "Beulah", "ND", 58523.0), (67570, "ONLINE", None, None), (1, "Paris", "", None),
            (None, None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, city string, state string, zip double")
    cols = [F.col(c) for c in ("id", "city", "state", "zip")]
    got = df.select(natural_key_text(*cols).alias("t"), merchant_key(*cols).alias("k")).collect()
    assert [r.t for r in got] == ["43293||Beulah||ND||58523.0", "67570||ONLINE||||", "1||Paris||||", "||||||"]
    assert [r.k for r in got] == [2360488786744616875, 7685775026189571555, 5381890532797450292,
                                  5918543378800215651]


def test_key_is_non_negative_and_not_null(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("t"))
    row = df.agg(F.min(surrogate_key(F.col("t"))).alias("lo"), F.count_if(surrogate_key(F.col("t")).isNull())).first()
    assert row[0] >= 0 and row[1] == 0
