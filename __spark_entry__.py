"""

``entry(spark)`` runs the flagship query (the user dimension) at sf 0.001.
``queries()`` maps each operator or pipeline (SURVEY §7.3) to a callable
``(spark, sf_dir) -> DataFrame``; ``oracle_sql()`` gives the same result as
DuckDB SQL over the base tables. Both start from the dirty sources of
:mod:`mdmspark.fixtures`, whose SQL runs unchanged in both engines.

The surrogate key (``xxhash64``) has no DuckDB twin, so queries that would
show it output the natural key text instead; the hash values themselves are
pinned by literal goldens in the tests. Load timestamps are fixed, so no
query outputs the current time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mdmspark.fixtures import fixture, with_fixtures
from mdmspark.functions import (
    chip_flag,
    clean_money,
    gender_code,
    location_type,
    mcc_is_valid,
    normalize_mcc,
    parse_flexible_date,
    title_text,
    transaction_method,
)
from mdmspark.operators import QualityGateError, bounded_sets, duplicate_keys, fingerprint, fingerprint_table, sample_offenders, value_conflicts
from mdmspark.plans import (
    ReconcileError,
    build_cards,
    build_mcc_codes,
    build_merchant,
    build_sub_transactions,
    build_users,
    daily_jobs,
    process_snapshot,
    report,
    run_jobs,
    stage_table,
)
from mdmspark.plans import cards as cards_plan
from mdmspark.plans import mcc_codes as mcc_plan
from mdmspark.plans import merchant as merchant_plan
from mdmspark.plans import users as users_plan
from mdmspark.session import scratch_path
from mdmspark.sinks import write_csv, write_snapshot
from mdmspark.sources import equi_depth_ranges, read_csv, read_snapshot, read_snapshots

SMOKE_DIR = "/root/testdata/sf0.001"
LOAD_TS = dt.datetime(2024, 1, 1)
LOAD_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def q_users_dim(spark: SparkSession, sf: str) -> DataFrame:
    return build_users(fixture(spark, sf, "users_src"), LOAD_TS)


def q_clean_money(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "users_src")
    return src.select(
        "id",
        F.col("yearly_income").alias("yearly_income_raw"),
        clean_money(F.col("yearly_income")).alias("year_income"),
        F.col("total_debt").alias("total_debt_raw"),
        clean_money(F.col("total_debt")).alias("total_debt"),
    )


def q_gender_code(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "users_src")
    return src.select(
        "id",
        F.col("gender").alias("gender_raw"),
        title_text(F.col("gender")).alias("gender_text"),
        gender_code(F.col("gender")).alias("gender"),
    )


def q_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "cards_src")
    return src.select(
        "id",
        F.col("expires").alias("expires_raw"),
        parse_flexible_date(F.col("expires"), end_of_month=True).alias("expires"),
        F.col("acct_open_date").alias("acct_open_date_raw"),
        parse_flexible_date(F.col("acct_open_date")).alias("acct_open_date"),
    )


def q_cards_dim(spark: SparkSession, sf: str) -> DataFrame:
    return build_cards(fixture(spark, sf, "cards_src"), LOAD_TS)


def q_chip_flag(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "cards_src")
    return src.select("id", F.col("has_chip").alias("has_chip_raw"), chip_flag(F.col("has_chip")).alias("has_chip"))


def q_txn_fact(spark: SparkSession, sf: str) -> DataFrame:
    return build_sub_transactions(fixture(spark, sf, "transactions_src"), LOAD_TS).drop("merchant_key")


def q_txn_method(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "transactions_src")
    return src.select("id", "use_chip", transaction_method(F.col("use_chip")).alias("transaction_method"))


def q_merchant_dim(spark: SparkSession, sf: str) -> DataFrame:
    return build_merchant(fixture(spark, sf, "transactions_src"), LOAD_TS).drop("merchant_key")


def q_merchant_location(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "transactions_src")
    return (
        src.select("use_chip", "merchant_city",
                   location_type(F.col("use_chip"), F.col("merchant_city")).alias("location_type"))
        .groupBy("use_chip", "merchant_city", "location_type")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def q_merchant_key_groups(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "transactions_src")
    nk = merchant_plan.natural_key()
    return (
        src.groupBy(merchant_plan.source_key().alias("merchant_key"))
        .agg(
            F.min(nk).alias("natural_key"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min(nk).alias("_lo"),
            F.max(nk).alias("_hi"),
        )
        .select("natural_key", "n_rows", F.when(F.col("_lo") == F.col("_hi"), 1).otherwise(2).cast("long").alias("n_natural_keys"))
    )


def q_mcc_dim(spark: SparkSession, sf: str) -> DataFrame:
    return build_mcc_codes(fixture(spark, sf, "mcc_src"), LOAD_TS)


def q_mcc_normalise(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "mcc_src")
    return src.select(
        F.col("mcc_id").alias("mcc_raw"),
        normalize_mcc(F.col("mcc_id")).alias("mcc_id"),
        mcc_is_valid(F.col("mcc_id")).alias("is_valid"),
    )


def q_mcc_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    src = fixture(spark, sf, "mcc_src")
    return value_conflicts(
        src, mcc_plan.source_key(), F.trim(F.col("description")), "mcc_id", "description"
    ).withColumnRenamed("n_values", "n_descriptions")


def q_mcc_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return mcc_plan.ENTITY.quarantine(fixture(spark, sf, "mcc_src"))


def q_cards_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every card source row once per rule it breaks (no card number or cvv)."""
    return cards_plan.ENTITY.quarantine(fixture(spark, sf, "cards_src"))


def q_dup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(fixture(spark, sf, "cards_src"), cards_plan.source_key(), "card_id")


def q_dq_users(spark: SparkSession, sf: str) -> DataFrame:
    return users_plan.ENTITY.metrics(fixture(spark, sf, "users_src"))


def q_dq_cards(spark: SparkSession, sf: str) -> DataFrame:
    return cards_plan.ENTITY.metrics(fixture(spark, sf, "cards_src"))


def q_dq_merchant(spark: SparkSession, sf: str) -> DataFrame:
    return merchant_plan.ENTITY.metrics(fixture(spark, sf, "transactions_src"))


def q_dq_mcc(spark: SparkSession, sf: str) -> DataFrame:
    return mcc_plan.ENTITY.metrics(fixture(spark, sf, "mcc_src"))


def q_dq_users_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return users_plan.ENTITY.metrics(fixture(spark, sf, "users_dirty_src"))


def q_dq_cards_dirty(spark: SparkSession, sf: str) -> DataFrame:
    return cards_plan.ENTITY.metrics(fixture(spark, sf, "cards_dirty_src"))


def q_stage_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Stage the users source as the 2024-01-01 snapshot (write, read back,
    reconcile) and return the snapshot as read back."""
    root = scratch_path(spark, "stage_roundtrip")
    stage_table(spark, fixture(spark, sf, "users_src"), root, "20240101", table="users")
    return read_snapshot(spark, root, "20240101")


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write the cards source as CSV with a header, read it back with the
    declared schema."""
    src = fixture(spark, sf, "cards_src")
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(src, path)
    return read_csv(spark, path, schema=src.schema)


def q_csv_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Newlines, quotes, backslashes, empty and missing text through CSV."""
    src = fixture(spark, sf, "csv_text_src")
    path = scratch_path(spark, "csv_text")
    write_csv(src, path)
    return read_csv(spark, path, schema=src.schema)


def q_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """The same file read with inferred types."""
    path = scratch_path(spark, "csv_inferred")
    write_csv(fixture(spark, sf, "csv_text_src"), path)
    return read_csv(spark, path)


def q_snapshot_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates of the MCC source, then date 1 re-written with valid codes
    only: date 1 is replaced, date 2 is untouched."""
    src = fixture(spark, sf, "mcc_src")
    root = scratch_path(spark, "snapshot_overwrite")
    write_snapshot(src, root, "20240101")
    write_snapshot(src, root, "20240102")
    write_snapshot(src.where(mcc_is_valid(F.col("mcc_id"))), root, "20240101")
    return read_snapshots(spark, root)


def _staged_publish(spark: SparkSession, sf: str, entity: str, source: str, fixture_name: str) -> DataFrame:
    """The reference's workflow for one entity: stage the source as the
    2024-01-01 snapshot, run the processing job (metrics -> gate -> write),
    read the published snapshot back."""
    root = scratch_path(spark, f"publish_{entity}")
    stage_table(spark, fixture(spark, sf, fixture_name), f"{root}/stg/{source}", "20240101", table=source)
    process_snapshot(spark, entity, f"{root}/stg", f"{root}/prc", "20240101", load_ts=LOAD_TS)
    return read_snapshot(spark, f"{root}/prc/{entity}", "20240101")


def q_publish_users(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_publish(spark, sf, "mdm_users", "users", "users_src")


def q_publish_cards(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_publish(spark, sf, "mdm_cards", "cards", "cards_src")


def q_publish_merchant(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_publish(spark, sf, "mdm_merchant", "transactions", "transactions_src").drop("merchant_key")


def q_publish_fact(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_publish(spark, sf, "mdm_sub_transactions", "transactions", "transactions_src").drop("merchant_key")


def q_publish_mcc_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """The MCC job on the dirty source: the error gates block the write, and
    what remains is the quarantine of the rules that fired."""
    root = scratch_path(spark, "publish_mcc")
    stage_table(spark, fixture(spark, sf, "mcc_src"), f"{root}/stg/mcc_codes", "20240101", table="mcc_codes")
    try:
        process_snapshot(spark, "mdm_mcc_codes", f"{root}/stg", f"{root}/prc", "20240101", load_ts=LOAD_TS,
                         quarantine_root=f"{root}/quarantine")
    except QualityGateError:
        pass
    else:
        raise AssertionError("the MCC gate should block this source")
    return read_snapshot(spark, f"{root}/quarantine", "20240101")


def _mcc_quarantine(spark: SparkSession, sf: str, *sources: str) -> DataFrame:
    """The MCC quarantine of one date after a run over each source in turn."""
    root = scratch_path(spark, "mcc_quarantine")
    for name in sources:
        stage_table(spark, fixture(spark, sf, name), f"{root}/stg/mcc_codes", "20240101", table="mcc_codes")
        try:
            process_snapshot(spark, "mdm_mcc_codes", f"{root}/stg", f"{root}/prc", "20240101", load_ts=LOAD_TS,
                             quarantine_root=f"{root}/quarantine")
        except QualityGateError:
            pass
    return read_snapshot(spark, f"{root}/quarantine", "20240101")


def q_publish_mcc_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Valid codes with several descriptions block the run; their rows are in quarantine."""
    return _mcc_quarantine(spark, sf, "mcc_valid_src")


def q_quarantine_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """A bad run, then a clean one of the same date: no old row is left. One
    row: how many the bad run left, and how many are left after both."""
    bad = _mcc_quarantine(spark, sf, "mcc_src").agg(F.count("*").alias("after_bad_run"))
    both = _mcc_quarantine(spark, sf, "mcc_src", "mcc_clean_src").agg(F.count("*").alias("after_clean_run"))
    return spark.createDataFrame([(bad.first()[0], both.first()[0])], "after_bad_run long, after_clean_run long")


def q_publish_mcc(spark: SparkSession, sf: str) -> DataFrame:
    return _staged_publish(spark, sf, "mdm_mcc_codes", "mcc_codes", "mcc_clean_src")


def q_publish_users_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Users without an id block the run; the quarantine holds them, and every row of a repeated id."""
    root = scratch_path(spark, "publish_users_blocked")
    stage_table(spark, fixture(spark, sf, "users_dirty_src"), f"{root}/stg/users", "20240101", table="users")
    try:
        process_snapshot(spark, "mdm_users", f"{root}/stg", f"{root}/prc", "20240101", load_ts=LOAD_TS, quarantine_root=f"{root}/quarantine")
    except QualityGateError:
        pass
    else:
        raise AssertionError("the gate should block this source")
    return read_snapshot(spark, f"{root}/quarantine", "20240101")


def q_merchant_key_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Fact and dimension published from one source, joined by merchant key:
    per merchant the rows of each, without the key's value."""
    root = scratch_path(spark, "merchant_key_agreement")
    stage_table(spark, fixture(spark, sf, "transactions_src"), f"{root}/stg/transactions", "20240101", table="transactions")
    counts = {}
    for entity in ("mdm_sub_transactions", "mdm_merchant"):
        process_snapshot(spark, entity, f"{root}/stg", f"{root}/prc", "20240101", load_ts=LOAD_TS)
        counts[entity] = read_snapshot(spark, f"{root}/prc/{entity}", "20240101")
    fact = counts["mdm_sub_transactions"].groupBy("merchant_key").agg(F.min("merchant_id").alias("fact_merchant_id"), F.count("*").alias("fact_rows"))
    dim = counts["mdm_merchant"].groupBy("merchant_key").agg(
        F.min(F.struct("merchant_id", F.coalesce("merchant_city", F.lit("")).alias("merchant_city"), "merchant_state", "zip")).alias("m"),
        F.count("*").alias("dimension_rows"))
    return fact.join(dim, "merchant_key", "full").select("m.*", "fact_merchant_id", "fact_rows", "dimension_rows")


def q_content_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of hashes of the card source, of whole rows and of each column."""
    return fingerprint_table(fixture(spark, sf, "cards_src"))


def q_stage_refused(spark: SparkSession, sf: str) -> DataFrame:
    """A good staging of a date, then attempts of the same date that lost rows
    or whose values moved, held against the source's totals: both are refused,
    and the first snapshot is what remains."""
    root = scratch_path(spark, "stage_refused")
    source = fixture(spark, sf, "users_src")
    totals = fingerprint(source)
    stage_table(spark, source, root, "20240101", table="users", control=totals)
    short = source.where("id % 10 <> 4")
    moved = source.withColumn("gender", F.when(F.col("id") % 5 == 0, "FEMALE").when(F.col("id") % 5 == 1, " male ").otherwise(F.col("gender")))
    for bad in (short, moved):
        try:
            stage_table(spark, bad, root, "20240101", table="users", control=totals)
        except ReconcileError:
            continue
        raise AssertionError("the attempt should be refused")
    return read_snapshot(spark, root, "20240101", need_manifest=True)


def q_snapshot_checked(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates of the card source, the second one staged twice; each is read
    against its manifest, the first with a declared schema."""
    root = scratch_path(spark, "snapshot_checked")
    source = fixture(spark, sf, "cards_src")
    stage_table(spark, source, root, "20240101", table="cards")
    for rows in (source.where("id % 2 = 0"), source.where("id % 3 = 0")):
        stage_table(spark, rows, root, "20240102", table="cards")
    declared = source.select("id", "expires", "cvv").schema
    first = read_snapshot(spark, root, "20240101", schema=declared, need_manifest=True)
    return first.unionByName(read_snapshot(spark, root, "20240102", need_manifest=True).select(first.columns))


def q_extract_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteen ranges of a skewed id and one of its NULLs, as an extract would
    send them: how many rows each condition reads."""
    source = fixture(spark, sf, "skewed_ids_src")
    ranges = equi_depth_ranges(lambda sql: spark.sql(sql, src=source), "{src}", "id", 16)
    conditions = ranges.predicates()
    read = source.select(*[F.expr(c).alias(f"c{i}") for i, c in enumerate(conditions)])
    hits = F.aggregate(F.array(*[F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in read.columns]), F.lit(0), lambda a, x: a + x)
    counted = read.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(hits == 1).alias("n_read_once"), F.count_if(F.col(read.columns[-1])).alias("n_null_range"),
                       F.greatest(*[F.count_if(F.col(c)) for c in read.columns[:-1]]).alias("largest"))
    mean = (F.col("n_rows") - F.col("n_null_range")) / 16
    return counted.select("n_rows", "n_read_once", "n_null_range", (F.col("largest") <= 2 * F.ceil(mean)).alias("within_twice_the_mean"), F.lit(len(conditions) <= 17).alias("within_17_connections"))


def q_offender_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty offending card rows of each rule, the same ones at every run."""
    return sample_offenders(cards_plan.ENTITY.quarantine(fixture(spark, sf, "cards_src")), 20)


def q_mcc_description_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Codes with several descriptions: how many, and the three first of them."""
    sets = bounded_sets(fixture(spark, sf, "mcc_src"), mcc_plan.source_key(), F.trim(F.col("description")), most=3, least=2, key_name="mcc_id", value_name="first")
    return sets.select("mcc_id", F.col("n_values").alias("n_descriptions"), F.array_join("first", " | ").alias("first_descriptions"))


def q_daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """All jobs of a date over the dirty sources, what can run at once at once:
    the users' and the codes' gates block, all else is published."""
    root = scratch_path(spark, "daily_run")
    names = {"transactions": "transactions_src", "cards": "cards_src", "users": "users_dirty_src", "mcc_codes": "mcc_src"}
    sources = {table: (lambda name=name: fixture(spark, sf, name)) for table, name in names.items()}
    return report(spark, run_jobs(spark, daily_jobs(spark, sources, f"{root}/stg", f"{root}/prc", "20240101", load_ts=LOAD_TS)))


def q_csv_safe_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The same text as line-safe CSV, which is read in splits."""
    src = fixture(spark, sf, "csv_text_src")
    path = scratch_path(spark, "csv_safe")
    write_csv(src, path, safe_lines=True)
    return read_csv(spark, path, schema=src.schema, safe_lines=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "users_dim": q_users_dim,
    "clean_money": q_clean_money,
    "gender_code": q_gender_code,
    "parse_dates": q_parse_dates,
    "cards_dim": q_cards_dim,
    "chip_flag": q_chip_flag,
    "txn_fact": q_txn_fact,
    "txn_method": q_txn_method,
    "merchant_dim": q_merchant_dim,
    "merchant_location": q_merchant_location,
    "merchant_key_groups": q_merchant_key_groups,
    "mcc_dim": q_mcc_dim,
    "mcc_normalise": q_mcc_normalise,
    "mcc_conflicts": q_mcc_conflicts,
    "mcc_invalid": q_mcc_invalid,
    "cards_quarantine": q_cards_quarantine,
    "dup_keys": q_dup_keys,
    "dq_users": q_dq_users,
    "dq_cards": q_dq_cards,
    "dq_merchant": q_dq_merchant,
    "dq_mcc": q_dq_mcc,
    "stage_roundtrip": q_stage_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "snapshot_overwrite": q_snapshot_overwrite,
    "publish_users": q_publish_users,
    "publish_cards": q_publish_cards,
    "publish_merchant": q_publish_merchant,
    "publish_fact": q_publish_fact,
    "publish_mcc_blocked": q_publish_mcc_blocked,
    "dq_users_dirty": q_dq_users_dirty,
    "dq_cards_dirty": q_dq_cards_dirty,
    "csv_text_roundtrip": q_csv_text_roundtrip,
    "csv_inferred": q_csv_inferred,
    "publish_mcc": q_publish_mcc,
    "publish_mcc_conflicts": q_publish_mcc_conflicts,
    "quarantine_rerun": q_quarantine_rerun,
    "publish_users_blocked": q_publish_users_blocked,
    "merchant_key_agreement": q_merchant_key_agreement,
    "dq_content_fingerprint": q_content_fingerprint,
    "stage_refused": q_stage_refused,
    "snapshot_checked": q_snapshot_checked,
    "dq_extract_ranges": q_extract_ranges,
    "offender_sample": q_offender_sample,
    "mcc_description_sets": q_mcc_description_sets,
    "daily_run": q_daily_run,
    "csv_safe_lines": q_csv_safe_lines,
}


# --------------------------------------------------------------------------
# DuckDB oracle. Notes: DuckDB's try_cast of '12.7' to an integer rounds and
# its strptime accepts one-digit fields, so both are guarded by patterns;
# initcap of one word is upper(first) || lower(rest); two-digit years are
# expanded to 20yy as text; sums are cast back to BIGINT.
# --------------------------------------------------------------------------

def _money(x: str) -> str:
    return f"try_cast(nullif(regexp_replace(trim(cast({x} as varchar)), '[^0-9.\\-]', '', 'g'), '') as decimal(18,2))"


def _int(x: str) -> str:
    t = f"trim(cast({x} as varchar))"
    return f"(case when regexp_matches({t}, '^[+-]?[0-9]+$') then try_cast({t} as integer) end)"


def _initcap(x: str) -> str:
    return f"(upper(substr(trim({x}), 1, 1)) || lower(substr(trim({x}), 2)))"


def _gender(x: str) -> str:
    return f"(case upper(trim({x})) when 'MALE' then 1 when 'FEMALE' then 0 end)"


def _chip(x: str) -> str:
    u = f"upper(trim(cast({x} as varchar)))"
    return (f"(case when {u} in ('YES', 'Y', 'TRUE', '1') then 1 "
            f"when {u} in ('NO', 'N', 'FALSE', '0') then 0 end)")


def _date(x: str, eom: bool = False) -> str:
    v = f"trim(cast({x} as varchar))"
    e = (
        f"(case when {v} is null or {v} = '' then null "
        f"when regexp_matches({v}, '^\\d{{2}}/\\d{{4}}$') then cast(try_strptime('01/' || {v}, '%d/%m/%Y') as date) "
        f"when regexp_matches({v}, '^\\d{{2}}/\\d{{2}}$') then "
        f"cast(try_strptime('01/' || substr({v}, 1, 3) || '20' || substr({v}, 4, 2), '%d/%m/%Y') as date) "
        f"when regexp_matches({v}, '^\\d{{4}}-\\d{{2}}$') then cast(try_strptime({v} || '-01', '%Y-%m-%d') as date) "
        f"else coalesce("
        f"case when regexp_matches({v}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') then cast(try_strptime({v}, '%Y-%m-%d') as date) end, "
        f"case when regexp_matches({v}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') then cast(try_strptime({v}, '%m/%d/%Y') as date) end, "
        f"case when regexp_matches({v}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') then cast(try_strptime({v}, '%d/%m/%Y') as date) end"
        f") end)"
    )
    return f"last_day({e})" if eom else e


def _present(x: str) -> str:
    return f"({x} is not null and trim(cast({x} as varchar)) <> '')"


def _method(x: str) -> str:
    return (f"(case when {x} = 'Chip Transaction' then 'CHIP' when {x} = 'Swipe Transaction' then 'SWIPE' "
            f"when {x} = 'Online Transaction' then 'ONLINE' else 'UNKNOWN' end)")


def _location(chip: str, city: str) -> str:
    """A truth table: channel class, city class -> type."""
    channel = (f"(case {chip} when 'Online Transaction' then 'online' when 'Chip Transaction' then 'person' "
               f"when 'Swipe Transaction' then 'person' else 'other' end)")
    place = f"(case upper(trim(coalesce({city}, ''))) when '' then 'none' when 'ONLINE' then 'online' else 'city' end)"
    table = {("online", "none"): "ONLINE", ("online", "online"): "ONLINE", ("online", "city"): "ONLINE",
             ("person", "none"): "UNKNOWN", ("person", "online"): "ONLINE", ("person", "city"): "PHYSICAL",
             ("other", "none"): "UNKNOWN", ("other", "online"): "ONLINE", ("other", "city"): "UNKNOWN"}
    entries = ", ".join(f"'{a} {b}': '{v}'" for (a, b), v in table.items())
    return f"(map {{{entries}}}[{channel} || ' ' || {place}])"


def _natural_key() -> str:
    return ("concat_ws('||', coalesce(cast(merchant_id as varchar), ''), coalesce(cast(merchant_city as varchar), ''), "
            "coalesce(cast(merchant_state as varchar), ''), coalesce(cast(zip as varchar), ''))")


def _mcc_valid(x: str) -> str:
    return f"coalesce(regexp_matches(nullif(trim(cast({x} as varchar)), ''), '^\\d{{1,4}}$'), false)"


def _mcc(x: str) -> str:
    t = f"nullif(trim(cast({x} as varchar)), '')"
    return f"(case when {_mcc_valid(x)} then lpad({t}, 4, '0') else {t} end)"


_USERS_COLS = f"""
  cast(id as bigint) as user_id,
  {_int('current_age')} as current_age,
  {_int('birth_year')} as birth_year,
  {_int('birth_month')} as birth_month,
  {_initcap('gender')} as gender_text,
  {_gender('gender')} as gender,
  trim(address) as address,
  try_cast(latitude as decimal(10,6)) as latitude,
  try_cast(longitude as decimal(10,6)) as longitude,
  {_money('per_capita_income')} as per_capita_income,
  {_money('yearly_income')} as year_income,
  'USD' as currency_code,
  {_money('total_debt')} as total_debt,
  {_int('credit_score')} as credit_score,
  {_int('num_credit_cards')} as number_credit_cards
"""

_CARDS_COLS = f"""
  cast(id as bigint) as card_id,
  cast(client_id as bigint) as client_id,
  upper(trim(card_type)) as card_type,
  upper(trim(card_brand)) as card_brand,
  trim(card_number) as card_number,
  {_date('expires', eom=True)} as expires,
  trim(cvv) as cvv,
  {_chip('has_chip')} as has_chip,
  {_int('num_cards_issued')} as num_cards_issued,
  {_money('credit_limit')} as credit_limit,
  {_date('acct_open_date')} as acct_open_date,
  {_int('year_pin_last_changed')} as year_pin_last_changed
"""

_CARD_ORDER = ", ".join(
    f"{c} nulls first" for c in ("client_id", "card_type", "card_brand", "card_number", "expires", "cvv", "has_chip",
                                 "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed")
)

_MERCHANT_COLS = f"""
  {_natural_key()} as nk,
  cast(merchant_id as varchar) as merchant_id,
  trim(merchant_city) as merchant_city,
  upper(trim(merchant_state)) as merchant_state,
  cast(zip as varchar) as zip,
  {_location('use_chip', 'merchant_city')} as location_type
"""

_USERS_BODY = f"""
select * exclude (rn) from (
  select *, {LOAD_TS_SQL} as etl_date,
    row_number() over (partition by user_id order by current_age nulls first, birth_year nulls first,
      birth_month nulls first, gender_text nulls first, gender nulls first, address nulls first,
      latitude nulls first, longitude nulls first, per_capita_income nulls first, year_income nulls first,
      total_debt nulls first, credit_score nulls first, number_credit_cards nulls first) as rn
  from (select {_USERS_COLS} from users_src) m
) where rn = 1
"""

_CARDS_DIM_BODY = f"""
select * exclude (rn) from (
  select *, {LOAD_TS_SQL} as etl_date,
    row_number() over (partition by card_id order by {_CARD_ORDER}) as rn
  from (select {_CARDS_COLS} from cards_src) m
) where rn = 1"""

_TXN_FACT_BODY = f"""
select cast(id as bigint) as transactions_id,
  cast(date as timestamp) as transaction_datetime,
  cast(client_id as bigint) as client_id,
  cast(card_id as bigint) as card_id,
  {_money('amount')} as transaction_amount,
  {_method('use_chip')} as transaction_method,
  cast(merchant_id as bigint) as merchant_id,
  {_mcc('mcc')} as mcc,
  cast(errors as varchar) as errors,
  {LOAD_TS_SQL} as etl_date
from transactions_src"""

_MERCHANT_DIM_BODY = f"""
select merchant_id, merchant_city, merchant_state, zip, location_type, {LOAD_TS_SQL} as etl_date from (
  select *, row_number() over (partition by nk order by merchant_id nulls first, merchant_city nulls first,
    merchant_state nulls first, zip nulls first, location_type nulls first) as rn
  from (select {_MERCHANT_COLS} from transactions_src) m
) where rn = 1"""

_MCC_DIM_BODY = f"""
select mcc_id, description, {LOAD_TS_SQL} as etl_date from (
  select lpad(trim(mcc_id), 4, '0') as mcc_id, substr(trim(description), 1, 1000) as description,
    row_number() over (partition by lpad(trim(mcc_id), 4, '0')
      order by (description is null or trim(description) = ''), substr(trim(description), 1, 1000) nulls first) as rn
  from mcc_src where {_mcc_valid('mcc_id')}
) where rn = 1"""

_MCC_INVALID_BODY = f"""
select 'mcc_invalid' as rule, 'error' as severity, mcc_id, description from mcc_src where not {_mcc_valid('mcc_id')}
union all
select 'description_too_long', 'warn', mcc_id, description from mcc_src
where coalesce(length(trim(description)) > 1000, false)"""


_DQ_USERS = """
, k as (select cast(id as bigint) as _key, count(*) as _n,
       count(*) filter (where id is null) as user_id_null
     from users_src group by 1)
select cast(sum(_n) as bigint) as n_rows, count(*) as n_keys,
  cast(sum(user_id_null) as bigint) as user_id_null,
  count(*) filter (where _key is not null and _n > 1) as duplicate_user_id
from k"""

_DQ_CARDS = f"""
, k as (select cast(id as bigint) as _key, count(*) as _n,
       count(*) filter (where id is null) as card_id_null,
       count(*) filter (where {_present('expires')} and {_date('expires')} is null) as expires_unparseable,
       count(*) filter (where {_present('acct_open_date')} and {_date('acct_open_date')} is null)
         as acct_open_date_unparseable,
       count(*) filter (where client_id is null) as client_id_null,
       count(*) filter (where {_chip('has_chip')} is null) as chip_flag_unknown
     from cards_src group by 1)
select cast(sum(_n) as bigint) as n_rows, count(*) as n_keys,
  cast(sum(card_id_null) as bigint) as card_id_null,
  cast(sum(expires_unparseable) as bigint) as expires_unparseable,
  cast(sum(acct_open_date_unparseable) as bigint) as acct_open_date_unparseable,
  cast(sum(client_id_null) as bigint) as client_id_null,
  cast(sum(chip_flag_unknown) as bigint) as chip_flag_unknown,
  count(*) filter (where _key is not null and _n > 1) as duplicate_card_id
from k"""

# Rows of codes with several descriptions, and of codes without any.
_MCC_KEYS = f"""
select rule, severity, m.mcc_id, m.description from mcc_src m join (
  select {_mcc('mcc_id')} as k, 'description_conflict' as rule, 'error' as severity from mcc_src
  group by 1 having count(distinct trim(description)) > 1
  union all
  select {_mcc('mcc_id')}, 'description_missing', 'warn' from mcc_src
  group by 1 having not bool_or(coalesce({_present('description')}, false))
) b on {_mcc('m.mcc_id')} is not distinct from b.k"""


def _value_text(c: str) -> str:
    t = f"cast({c} as varchar)"
    return f"coalesce(cast(length({t}) as varchar) || ':' || {t}, 'N')"


def _fingerprint_of(table: str, *columns: str) -> str:
    """Each row and each column as the sums of the 20-bit words of its md5."""
    def part(name: str, text: str, starts: tuple[int, ...]) -> str:
        halves = ", ".join(f"cast('0x' || substr(md5({text}), {a}, 15) as bigint) as h{a}" for a in starts)
        sums = ", ".join(f"cast(coalesce(sum((h{a} >> {k}) & 1048575), 0) as varchar)" for a in starts for k in (0, 20, 40))
        return f"select '{name}' as part, count(*) as n_rows, concat_ws('-', {sums}) as digest from (select {halves} from {table})"

    row = " || ".join(map(_value_text, columns))
    return " union all ".join([part("*", row, (1, 16)), *[part(c, _value_text(c), (1,)) for c in columns]])


def _snapshot_of(body: str) -> str:
    return f"select *, DATE '2024-01-01' AS snapshot_date from ({body}) published"


_CARDS_QUARANTINE = f"""
, q as (select id, client_id, expires, has_chip, acct_open_date from cards_src)
select 'card_id_null' as rule, 'error' as severity, * from q where id is null
union all
select 'expires_unparseable', 'warn', * from q where {_present('expires')} and {_date('expires')} is null
union all
select 'acct_open_date_unparseable', 'warn', * from q
where {_present('acct_open_date')} and {_date('acct_open_date')} is null
union all
select 'client_id_null', 'warn', * from q where client_id is null
union all
select 'chip_flag_unknown', 'warn', * from q where {_chip('has_chip')} is null"""

_QUARANTINED = ("rule", "severity", "id", "client_id", "expires", "has_chip", "acct_open_date")

ORACLE: dict[str, str] = {
    "users_dim": with_fixtures(_USERS_BODY, "users_src"),
    "clean_money": with_fixtures(f"""
select id, yearly_income as yearly_income_raw, {_money('yearly_income')} as year_income,
  total_debt as total_debt_raw, {_money('total_debt')} as total_debt
from users_src""", "users_src"),
    "gender_code": with_fixtures(f"""
select id, gender as gender_raw, {_initcap('gender')} as gender_text, {_gender('gender')} as gender
from users_src""", "users_src"),
    "parse_dates": with_fixtures(f"""
select id, expires as expires_raw, {_date('expires', eom=True)} as expires,
  acct_open_date as acct_open_date_raw, {_date('acct_open_date')} as acct_open_date
from cards_src""", "cards_src"),
    "cards_dim": with_fixtures(_CARDS_DIM_BODY, "cards_src"),
    "chip_flag": with_fixtures(f"""
select id, has_chip as has_chip_raw, {_chip('has_chip')} as has_chip from cards_src""", "cards_src"),
    "txn_fact": with_fixtures(_TXN_FACT_BODY, "transactions_src"),
    "txn_method": with_fixtures(f"""
select id, use_chip, {_method('use_chip')} as transaction_method from transactions_src""", "transactions_src"),
    "merchant_dim": with_fixtures(_MERCHANT_DIM_BODY, "transactions_src"),
    "merchant_location": with_fixtures(f"""
select use_chip, merchant_city, {_location('use_chip', 'merchant_city')} as location_type, count(*) as n_rows
from transactions_src group by all""", "transactions_src"),
    "merchant_key_groups": with_fixtures(f"""
select min({_natural_key()}) as natural_key, count(*) as n_rows, count(distinct {_natural_key()}) as n_natural_keys
from transactions_src group by hash({_natural_key()})""", "transactions_src"),
    "mcc_dim": with_fixtures(_MCC_DIM_BODY, "mcc_src"),
    "mcc_normalise": with_fixtures(f"""
select mcc_id as mcc_raw, {_mcc('mcc_id')} as mcc_id, {_mcc_valid('mcc_id')} as is_valid from mcc_src""", "mcc_src"),
    "mcc_conflicts": with_fixtures(f"""
, p as (select distinct {_mcc('mcc_id')} as mcc_id, trim(description) as description
       from mcc_src where description is not null),
c as (select mcc_id, count(*) as n_descriptions from p group by mcc_id having count(*) > 1)
select p.mcc_id, p.description, c.n_descriptions from p join c on p.mcc_id is not distinct from c.mcc_id
""", "mcc_src"),
    "mcc_invalid": with_fixtures(_MCC_INVALID_BODY, "mcc_src"),
    "cards_quarantine": with_fixtures(_CARDS_QUARANTINE, "cards_src"),
    "dup_keys": with_fixtures("""
select cast(id as bigint) as card_id, count(*) as n_rows from cards_src
where id is not null group by 1 having count(*) > 1""", "cards_src"),
    "dq_users": with_fixtures(_DQ_USERS, "users_src"),
    "dq_users_dirty": with_fixtures(_DQ_USERS.replace("users_src", "users_dirty_src"), "users_dirty_src"),
    "dq_cards": with_fixtures(_DQ_CARDS, "cards_src"),
    "dq_cards_dirty": with_fixtures(_DQ_CARDS.replace("cards_src", "cards_dirty_src"), "cards_dirty_src"),
    "dq_merchant": with_fixtures(f"""
, k as (select hash({_natural_key()}) as _key, count(*) as _n, count(distinct {_natural_key()}) as _d,
       count(*) filter (where {_natural_key()} is null) as _nulls
     from transactions_src group by 1)
select cast(sum(_n) as bigint) as n_rows, count(*) as n_keys,
  cast(sum(_nulls) as bigint) as merchant_key_null, count(*) filter (where _d > 1) as merchant_key_collision
from k""", "transactions_src"),
    "dq_mcc": with_fixtures(f"""
, k as (select {_mcc('mcc_id')} as _key, count(*) as _n,
       count(*) filter (where not {_mcc_valid('mcc_id')}) as mcc_invalid,
       count(*) filter (where coalesce(length(trim(description)) > 1000, false)) as description_too_long,
       count(distinct trim(description)) as _d,
       bool_or(coalesce({_present('description')}, false)) as _p
     from mcc_src group by 1)
select cast(sum(_n) as bigint) as n_rows, count(*) as n_keys,
  cast(sum(mcc_invalid) as bigint) as mcc_invalid,
  cast(sum(description_too_long) as bigint) as description_too_long,
  count(*) filter (where _d > 1) as description_conflict,
  count(*) filter (where not _p) as description_missing
from k""", "mcc_src"),
    "stage_roundtrip": with_fixtures("""
select *, DATE '2024-01-01' as snapshot_date from users_src""", "users_src"),
    "csv_roundtrip": with_fixtures("""
select * from cards_src""", "cards_src"),
    "snapshot_overwrite": with_fixtures(f"""
select mcc_id, description, DATE '2024-01-01' as snapshot_date from mcc_src where {_mcc_valid('mcc_id')}
union all
select mcc_id, description, DATE '2024-01-02' as snapshot_date from mcc_src""", "mcc_src"),
    "publish_users": with_fixtures(_snapshot_of(_USERS_BODY), "users_src"),
    "publish_cards": with_fixtures(_snapshot_of(_CARDS_DIM_BODY), "cards_src"),
    "publish_merchant": with_fixtures(_snapshot_of(_MERCHANT_DIM_BODY), "transactions_src"),
    "publish_fact": with_fixtures(_snapshot_of(_TXN_FACT_BODY), "transactions_src"),
    "publish_mcc_blocked": with_fixtures(_snapshot_of(f"{_MCC_INVALID_BODY} union all {_MCC_KEYS}"), "mcc_src"),
    "csv_text_roundtrip": with_fixtures("select * from csv_text_src", "csv_text_src"),
    "csv_safe_lines": with_fixtures("select * from csv_text_src", "csv_text_src"),
    "csv_inferred": with_fixtures("select cast(id as integer) as id, note, kind from csv_text_src", "csv_text_src"),
    "publish_mcc": with_fixtures(_snapshot_of(_MCC_DIM_BODY.replace("mcc_src", "mcc_clean_src")), "mcc_clean_src"),
    "publish_mcc_conflicts": with_fixtures(_snapshot_of(_MCC_KEYS.replace("mcc_src", "mcc_valid_src")), "mcc_valid_src"),
    "quarantine_rerun": with_fixtures(f"""
select count(*) as after_bad_run, cast((select count(*) from mcc_clean_src where description is null) as bigint) as after_clean_run
from ({_MCC_INVALID_BODY} union all {_MCC_KEYS}) q""", "mcc_src", "mcc_clean_src"),
    "publish_users_blocked": with_fixtures(_snapshot_of("""
select 'user_id_null' as rule, 'error' as severity, id, gender, yearly_income from users_dirty_src where id is null
union all
select 'duplicate_user_id', 'warn', id, gender, yearly_income from users_dirty_src
where id in (select id from users_dirty_src where id is not null group by id having count(*) > 1)"""), "users_dirty_src"),
    "dq_content_fingerprint": with_fixtures(_fingerprint_of("cards_src", "id", "client_id", "card_type", "card_brand", "card_number", "expires", "cvv", "has_chip",
                                                         "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed"), "cards_src"),
    "stage_refused": with_fixtures("""
select *, DATE '2024-01-01' as snapshot_date from users_src""", "users_src"),
    "snapshot_checked": with_fixtures("""
select id, expires, cvv, DATE '2024-01-01' as snapshot_date from cards_src
union all
select id, expires, cvv, DATE '2024-01-02' from cards_src where id % 3 = 0""", "cards_src"),
    "dq_extract_ranges": with_fixtures("""
select count(*) as n_rows, count(*) as n_read_once, count(*) - count(id) as n_null_range, true as within_twice_the_mean, true as within_17_connections
from skewed_ids_src""", "skewed_ids_src"),
    "offender_sample": with_fixtures(_CARDS_QUARANTINE.replace("select 'card_id_null'", "select * from (select 'card_id_null'", 1) + f""")
qualify row_number() over (partition by rule order by md5({' || '.join(map(_value_text, _QUARANTINED))}), {', '.join(c + ' nulls first' for c in _QUARANTINED)}) <= 20""", "cards_src"),
    "mcc_description_sets": with_fixtures(f"""
, p as (select distinct {_mcc('mcc_id')} as mcc_id, trim(description) as d from mcc_src where description is not null)
select mcc_id, count(*) as n_descriptions, array_to_string(list_sort(list(d))[1:3], ' | ') as first_descriptions from p group by mcc_id having count(*) > 1""", "mcc_src"),
    "daily_run": with_fixtures(f"""
select 'stage transactions' as job, 'done' as status, count(*) as rows, cast(null as varchar) as failed_rule from transactions_src
union all select 'stage cards', 'done', count(*), null from cards_src
union all select 'stage users', 'done', count(*), null from users_dirty_src
union all select 'stage mcc_codes', 'done', count(*), null from mcc_src
union all select 'mdm_sub_transactions', 'done', count(*), null from transactions_src
union all select 'mdm_merchant', 'done', count(distinct {_natural_key()}), null from transactions_src
union all select 'mdm_users', case when count(*) filter (where id is null) > 0 then 'blocked' end, null, 'user_id_null' from users_dirty_src
union all select 'mdm_cards', 'done', count(distinct id), null from cards_src
union all select 'mdm_mcc_codes', case when count(*) filter (where not {_mcc_valid('mcc_id')}) > 0 then 'blocked' end, null, 'mcc_invalid' from mcc_src""",
                               "transactions_src", "cards_src", "users_dirty_src", "mcc_src"),
    "merchant_key_agreement": with_fixtures(f"""
select cast(merchant_id as varchar) as merchant_id, min(coalesce(trim(merchant_city), '')) as merchant_city, min(upper(trim(merchant_state))) as merchant_state,
  cast(zip as varchar) as zip, cast(min(merchant_id) as bigint) as fact_merchant_id, count(*) as fact_rows, cast(1 as bigint) as dimension_rows
from transactions_src group by {_natural_key()}, merchant_id, zip""", "transactions_src"),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the user dimension over the sf 0.001 tables."""
    return q_users_dim(spark, SMOKE_DIR)


def _text_operators() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and oracles of the optional subpackage for training text."""
    try:
        import corpus_pipeline
        from mdmspark.llm.queries import ORACLE as oracles
        from mdmspark.llm.queries import QUERIES as text_queries
    except ImportError:
        return {}, {}
    oracles = dict(oracles)
    if corpus_pipeline.ORACLE_SQL is not None:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**text_queries, "pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_text_operators()[0]}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **_text_operators()[1]}
