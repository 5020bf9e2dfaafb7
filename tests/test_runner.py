"""Jobs of a date in one run, and how many files a write makes."""

import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from mdmspark.fixtures import fixture
from mdmspark.plans import Job, daily_jobs, process_snapshot, report, run_jobs, stage_table
from mdmspark.sinks import planned_files, size_files
from mdmspark.sources import Store, read_snapshot, snapshot_path


def test_jobs_run_after_what_they_need(spark):
    seen, lock = [], threading.Lock()

    def job(name, *needs):
        def run():
            with lock:
                seen.append(name)
            return len(name)

        return Job(name, run, needs)

    results = run_jobs(spark, [job("d", "b", "c"), job("b", "a"), job("a"), job("c", "a")])
    assert [(r.job, r.status, r.rows) for r in results] == [("d", "done", 1), ("b", "done", 1), ("a", "done", 1), ("c", "done", 1)]
    assert seen[0] == "a" and seen[-1] == "d" and set(seen) == set("abcd")


def test_independent_jobs_run_at_the_same_time_in_pools_of_their_own(spark):
    meet, pools = threading.Barrier(3, timeout=60), {}

    def job(name):
        def run():
            meet.wait()  # passes only if all three are running
            pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            return spark.range(10).count()

        return Job(name, run)

    assert [r.rows for r in run_jobs(spark, [job("x"), job("y"), job("z")], at_once=3)] == [10, 10, 10]
    assert pools == {"x": "x", "y": "y", "z": "z"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_failure_stops_only_what_needs_it(spark):
    def fails():
        raise OSError("no such host")

    results = {r.job: r for r in run_jobs(spark, [Job("a", fails), Job("b", lambda: 1, ("a",)), Job("c", lambda: 1, ("b",)), Job("d", lambda: 7)])}
    assert (results["a"].status, results["a"].failed_rule) == ("failed", "OSError") and isinstance(results["a"].error, OSError)
    assert (results["b"].status, results["b"].failed_rule) == ("skipped", "a") and results["c"].status == "skipped" and results["d"].rows == 7
    rows = {r.job: tuple(r) for r in report(spark, list(results.values())).collect()}
    assert rows["b"] == ("b", "skipped", None, "a") and rows["d"] == ("d", "done", 7, None)


@pytest.mark.parametrize("jobs,says", [([("a", ()), ("a", ())], "twice"), ([("a", ("x",))], "unknown"), ([("a", ("b",)), ("b", ("a",))], "circle")])
def test_bad_plans_are_refused_before_anything_runs(spark, jobs, says):
    with pytest.raises(ValueError, match=says):
        run_jobs(spark, [Job(n, lambda: pytest.fail("ran"), needs) for n, needs in jobs])


def test_a_blocked_gate_stops_only_its_own_entity(spark, tmp_root):
    names = {"users": "users_src", "mcc_codes": "mcc_src", "cards": "cards_src"}
    sources = {t: (lambda n=n: fixture(spark, SF001, n)) for t, n in names.items()}
    results = {r.job: r for r in run_jobs(spark, daily_jobs(spark, sources, f"{tmp_root}/stg", f"{tmp_root}/prc", "20240101"))}
    assert set(results) == {"stage users", "stage mcc_codes", "stage cards", "mdm_users", "mdm_mcc_codes", "mdm_cards"}
    assert (results["mdm_mcc_codes"].status, results["mdm_mcc_codes"].failed_rule) == ("blocked", "mcc_invalid")
    assert results["mdm_users"].rows == read_snapshot(spark, f"{tmp_root}/prc/mdm_users", "20240101").count()
    assert all(r.status == "done" for n, r in results.items() if n != "mdm_mcc_codes")


def test_a_source_that_cannot_be_read_skips_its_entities(spark, tmp_root):
    def gone():
        raise ConnectionError("refused")

    sources = {"transactions": gone, "users": lambda: fixture(spark, SF001, "users_src")}
    results = {r.job: (r.status, r.failed_rule) for r in run_jobs(spark, daily_jobs(spark, sources, f"{tmp_root}/stg", f"{tmp_root}/prc", "20240101"))}
    assert results["stage transactions"] == ("failed", "ConnectionError")
    assert results["mdm_sub_transactions"] == results["mdm_merchant"] == ("skipped", "stage transactions") and results["mdm_users"][0] == "done"


# -- files --------------------------------------------------------------------

def published_files(spark, root):
    return len(Store(spark, root).files(snapshot_path(root, "20240101")))


def test_planned_files():
    assert [planned_files(b, 100) for b in (0, 1, 150, 1000, 1001)] == [2, 2, 2, 10, 11]
    with pytest.raises(ValueError):
        planned_files(5, 0)


def test_many_tiny_splits_give_few_files_and_one_large_split_several(spark, tmp_root):
    src = fixture(spark, SF001, "transactions_src")
    rows = src.count()
    for name, splits, file_bytes, low, high in (("tiny", 64, 1 << 20, 2, 8), ("large", 1, 20_000, 5, 12)):
        stage_table(spark, src.repartition(splits), f"{tmp_root}/{name}/transactions", "20240101")
        if name == "tiny":  # files that are read one by one
            spark.conf.set("spark.sql.files.openCostInBytes", "256m")
        process_snapshot(spark, "mdm_sub_transactions", f"{tmp_root}/{name}", f"{tmp_root}/{name}/prc", "20240101", file_bytes=file_bytes)
        spark.conf.unset("spark.sql.files.openCostInBytes")
        out = f"{tmp_root}/{name}/prc/mdm_sub_transactions"
        assert low <= published_files(spark, out) <= high, name
        assert read_snapshot(spark, out, "20240101").count() == rows


def test_well_sized_splits_are_written_as_they_are(spark):
    df = spark.range(100).repartition(6)
    assert size_files(df, 600, 100) is df
    for frame, total in ((df, 600 * 9), (spark.range(100).repartition(20), 10)):
        out = size_files(frame, total, 100)
        assert out is not frame and out.rdd.getNumPartitions() == planned_files(total, 100)
        assert out.agg(F.sum("id")).first()[0] == 4950
