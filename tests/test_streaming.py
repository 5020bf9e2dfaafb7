"""The entity projections are stateless built-in expressions, so the fact
mapping also runs on a file stream (the reference itself is batch only)."""

from conftest import SF001
from mdmspark.fixtures import fixture
from mdmspark.plans import ENTITIES
from mdmspark.session import scratch_path
from mdmspark.sinks import write_parquet


def test_fact_projection_on_a_stream(spark):
    src = fixture(spark, SF001, "transactions_src")
    landing = scratch_path(spark, "stream-landing")
    write_parquet(src, landing)
    e = ENTITIES["mdm_sub_transactions"]
    stream = spark.readStream.schema(src.schema).parquet(landing)
    mapped = e.mapped(stream)
    assert mapped.isStreaming
    query = (
        mapped.writeStream.format("memory").queryName("fact_stream_test")
        .option("checkpointLocation", scratch_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.table("fact_stream_test").collect()), key=repr)
    want = sorted(map(tuple, e.mapped(src).collect()), key=repr)
    assert got == want and len(got) == src.count()
