"""Samples of offenders, bounded sets and the scope of persisted frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from mdmspark.cli import main
from mdmspark.fixtures import fixture
from mdmspark.operators import FrameScope, QualityGateError, bounded_sets, sample_offenders
from mdmspark.plans import ENTITIES, publish_entity, stage_table
from mdmspark.plans import publish as publish_module

LOAD = dt.datetime(2024, 1, 1)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# -- samples ------------------------------------------------------------------

def hits(spark, n):
    """One rule that every row breaks, one that few do."""
    rows = [("all", i, f"v{i % 7}") for i in range(n)] + [("few", i, None) for i in range(5)]
    random.Random(n).shuffle(rows)
    return spark.createDataFrame(rows, "rule string, id long, v string")


def test_sample_is_bounded_repeatable_and_complete_for_small_rules(spark):
    df = hits(spark, 3000)
    first = sorted(map(str, sample_offenders(df.repartition(7), 20).collect()))
    again = sorted(map(str, sample_offenders(df.orderBy("id").coalesce(1), 20).collect()))
    assert first == again and len(first) == 25
    ids = [r.id for r in sample_offenders(df, 20).collect() if r.rule == "all"]
    assert max(ids) > 500  # spread over the rows, not the first ones


def test_rows_are_cut_before_the_shuffle(spark):
    plan = executed(sample_offenders(hits(spark, 3000).repartition(7), 20))
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    limits = [i for i in range(len(final)) if final.startswith("WindowGroupLimit", i)]
    assert len(limits) == 2 and any(limits[0] < at < limits[1] for at in (i for i in range(len(final)) if final.startswith("Exchange hashpartitioning(rule", i)))


def test_repeated_offenders_and_bad_sizes(spark):
    df = spark.createDataFrame([("r", 1, "a")] * 30 + [("r", None, None)], "rule string, id long, v string")
    assert len(sample_offenders(df, 20).collect()) == 20
    assert sample_offenders(df.limit(0), 20).count() == 0
    with pytest.raises(ValueError):
        sample_offenders(df, 0)


def test_a_blocked_gate_carries_its_sample(spark, tmp_root):
    src = fixture(spark, SF001, "mcc_src")
    found = {}
    for name, root in (("no quarantine", None), ("quarantine", f"{tmp_root}/q")):
        with pytest.raises(QualityGateError) as err:
            publish_entity(ENTITIES["mdm_mcc_codes"], src, f"{tmp_root}/t", "20240101", load_ts=LOAD, offender_sample=20, quarantine_root=root)
        found[name] = sorted(map(str, err.value.result.offenders))
    rules = [r.split("'")[3] for r in found["quarantine"]]
    assert found["no quarantine"] == found["quarantine"] and all(rules.count(r) <= 20 for r in rules)
    assert {"mcc_invalid", "description_conflict"} <= set(rules)


def test_a_warning_carries_its_sample(spark, tmp_root):
    rep = publish_entity(ENTITIES["mdm_cards"], fixture(spark, SF001, "cards_src"), f"{tmp_root}/t", "20240101", load_ts=LOAD, offender_sample=3)
    rules = [r["rule"] for r in rep.offenders]
    assert rules and all(rules.count(r) <= 3 for r in rules) and "card_number" not in rep.offenders[0]


def test_command_line_prints_previews_and_offenders(spark, tmp_root, capsys):
    stage_table(spark, fixture(spark, SF001, "cards_src"), f"{tmp_root}/stg/cards", "20240101")
    stage_table(spark, fixture(spark, SF001, "mcc_src"), f"{tmp_root}/stg/mcc_codes", "20240101")
    common = ["--etl-date", "20240101", "--stg-root", f"{tmp_root}/stg", "--prc-root", f"{tmp_root}/prc", "--offenders", "2"]
    assert main(["process", "--entity", "mdm_cards", *common, "--preview-source", "2", "--preview", "1", "--persist-source"], spark) == 0
    out = capsys.readouterr().out
    assert out.count("Row(") == 3 and "card_number" not in out and "cvv" not in out and "offender: rule='client_id_null'" in out
    assert main(["process", "--entity", "mdm_mcc_codes", *common], spark) == 1
    assert "offender: rule='mcc_invalid'" in capsys.readouterr().out


# -- bounded sets -------------------------------------------------------------

def test_sets_equal_python(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None, "c"]), rng.choice([None, *[f"v{i}" for i in range(9)]])) for _ in range(400)] + [("d", None), ("e", "v1"), ("e", "v1")]
    for most, least in ((3, 1), (20, 2)):
        got = {r.k: (r.n_values, r.first) for r in bounded_sets(spark.createDataFrame(rows, "k string, v string"), F.col("k"), F.col("v"), most, least, "k", "first").collect()}
        sets = {}
        for k, v in rows:
            sets.setdefault(k, set()).update([] if v is None else [v])
        assert got == {k: (len(s), sorted(s)[:most]) for k, s in sets.items() if len(s) >= least}


def test_a_key_with_a_third_of_all_rows_and_of_all_values(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), F.col("id").cast("string").alias("v"))
    out = bounded_sets(df, F.col("k"), F.col("v"), 5)
    hot = out.where("key = 'hot'").first()
    assert hot.n_values == 20_000 and list(hot["values"]) == sorted(str(i) for i in range(0, 60_000, 3))[:5]
    plan = executed(out)
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "collect_set" not in plan
    with pytest.raises(ValueError):
        bounded_sets(df, F.col("k"), F.col("v"), 0)


# -- scope --------------------------------------------------------------------

def persisted(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_no_frame_is_left_on_any_way_out(spark, tmp_root, monkeypatch):
    before = persisted(spark)
    cards, mcc = fixture(spark, SF001, "cards_src"), fixture(spark, SF001, "mcc_src")
    publish_entity(ENTITIES["mdm_cards"], cards, f"{tmp_root}/a", "20240101", load_ts=LOAD, persist_source=True)
    assert persisted(spark) == before
    with pytest.raises(QualityGateError):
        publish_entity(ENTITIES["mdm_mcc_codes"], mcc, f"{tmp_root}/b", "20240101", load_ts=LOAD, persist_source=True, offender_sample=5)
    assert persisted(spark) == before

    def fails(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(publish_module, "write_snapshot", fails)
    with pytest.raises(OSError):
        publish_entity(ENTITIES["mdm_cards"], cards, f"{tmp_root}/c", "20240101", load_ts=LOAD, persist_source=True)
    assert persisted(spark) == before


def test_scope_counts_and_releases(spark):
    before = persisted(spark)
    with FrameScope() as frames:
        a = frames.keep(spark.range(5))
        assert frames.keep(a) is a  # already persisted: kept once
        b = frames.keep(spark.range(6), when=False)
        assert (frames.held, frames.kept) == (1, 1) and not b.is_cached
        a.count()
        c = frames.keep(spark.range(7))
        c.count()
        assert persisted(spark) == before + 2
        frames.release(a)
        assert frames.held == 1 and persisted(spark) == before + 1
    assert frames.held == 0 and persisted(spark) == before


def test_a_frame_of_the_caller_stays(spark):
    mine = spark.range(9).persist()
    mine.count()
    with FrameScope() as frames:
        frames.keep(mine)
        assert frames.held == 0
    assert mine.is_cached
    mine.unpersist()


def test_a_frame_that_cannot_be_released_hides_no_error(spark):
    class Stuck:
        def unpersist(self):
            raise RuntimeError("stuck")

    frames = FrameScope()
    with pytest.raises(ValueError, match="first"):
        with frames:
            kept = frames.keep(spark.range(3))
            frames._held.append(Stuck())
            raise ValueError("first")
    assert not kept.is_cached
    with pytest.raises(RuntimeError, match="stuck"):
        with FrameScope() as frames:
            frames._held.append(Stuck())
