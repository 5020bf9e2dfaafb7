"""Command-line jobs, run in-process on the test session."""

import pytest

from conftest import SF001
from mdmspark.cli import main
from mdmspark.fixtures import fixture
from mdmspark.plans import stage_table
from mdmspark.sources import read_snapshot


@pytest.fixture(scope="module")
def staged_root(spark):
    from mdmspark.session import scratch_path

    root = scratch_path(spark, "cli")
    for t, f in {"users": "users_src", "mcc_codes": "mcc_src"}.items():
        stage_table(spark, fixture(spark, SF001, f), f"{root}/stg/{t}", "20240101", table=t)
    return root


def test_process_ok(spark, staged_root, capsys):
    rc = main(["process", "--entity", "mdm_users", "--etl-date", "20240101", "--stg-root", f"{staged_root}/stg",
               "--prc-root", f"{staged_root}/prc", "--preview", "5"], spark=spark)
    assert rc == 0
    out = capsys.readouterr().out
    assert "published mdm_users" in out and out.count("Row(") == 5
    assert read_snapshot(spark, f"{staged_root}/prc/mdm_users", "20240101").count() == 143


def test_process_blocked_by_gate(spark, staged_root, capsys):
    rc = main(["process", "--entity", "mdm_mcc_codes", "--etl-date", "20240101", "--stg-root",
               f"{staged_root}/stg", "--prc-root", f"{staged_root}/prc", "--quarantine-root",
               f"{staged_root}/quarantine"], spark=spark)
    assert rc == 1
    assert "mcc_invalid=" in capsys.readouterr().err
    assert read_snapshot(spark, f"{staged_root}/quarantine/mdm_mcc_codes", "20240101").count() > 0


def test_bad_date_rejected_before_any_job(spark):
    with pytest.raises(SystemExit) as err:
        main(["process", "--entity", "mdm_users", "--etl-date", "2024111", "--stg-root", "x", "--prc-root", "y"],
             spark=spark)
    assert err.value.code == 2
