"""Command-line jobs: one run stages a table or processes an entity for one
snapshot date, like the reference's per-table scripts.

    python -m mdmspark stage   --table cards --etl-date 20240101 --stg-root s3a://.../stg \
        --jdbc-options jdbc.json [--source-table schema.cards] [--partition-column id --num-partitions 64]
    python -m mdmspark process --entity mdm_cards --etl-date 20240101 \
        --stg-root .../stg --prc-root .../prc [--quarantine-root .../quarantine]

The session comes from ``SparkSession.builder.getOrCreate()``: master,
resources and ``spark.checkpoint.dir`` are whatever ``spark-submit`` or the
cluster sets. Exit status 0 on success, 2 for a bad argument (a date that is
not YYYYMMDD included), 1 when a gate blocks or the counts do
not reconcile (the reason is printed); any other error propagates.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from mdmspark.operators.quality import QualityGateError
from mdmspark.plans.publish import ENTITIES, PublishError, process_snapshot
from mdmspark.plans.staging import ReconcileError, stage_from_jdbc
from mdmspark.sources.files import parse_snapshot_date, read_snapshot
from mdmspark.sources.jdbc import SOURCE_TABLES
from mdmspark.sources.manifest import SnapshotError


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mdmspark")
    sub = p.add_subparsers(dest="command", required=True)

    st = sub.add_parser("stage", help="extract a source table over JDBC into a dated snapshot")
    st.add_argument("--table", required=True, choices=sorted(SOURCE_TABLES))
    st.add_argument("--etl-date", required=True, help="YYYYMMDD")
    st.add_argument("--stg-root", required=True)
    st.add_argument("--jdbc-options", required=True, help="JSON file with url, user, password, driver, ...")
    st.add_argument("--source-table", help="name of the table in the database")
    st.add_argument("--partition-column", help="numeric, date or timestamp column whose ranges are read in parallel")
    st.add_argument("--num-partitions", type=int, help="connections (default: the session's default parallelism)")
    st.add_argument("--single-connection", action="store_true", help="read through one connection")

    pr = sub.add_parser("process", help="build, check and publish one entity from a staged snapshot")
    pr.add_argument("--entity", required=True, choices=sorted(ENTITIES))
    pr.add_argument("--etl-date", required=True, help="YYYYMMDD")
    pr.add_argument("--stg-root", required=True)
    pr.add_argument("--prc-root", required=True)
    pr.add_argument("--quarantine-root")
    pr.add_argument("--files", type=int, help="about this many output files (adds a shuffle)")
    pr.add_argument("--preview", type=int, default=0, help="print so many published rows")
    pr.add_argument("--preview-source", type=int, default=0, help="print so many staged rows")
    pr.add_argument("--offenders", type=int, default=0, metavar="N", help="print N offending rows of each rule that fired")
    pr.add_argument("--persist-source", action="store_true", help="keep the source in memory and on disk during the run")
    return p


def _print_offenders(rows: Sequence[dict]) -> None:
    for row in rows:
        print("offender: " + ", ".join(f"{k}={v!r}" for k, v in row.items()))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    try:
        parse_snapshot_date(args.etl_date)  # reject a bad date before starting any job
    except ValueError as err:
        parser.error(str(err))  # exit status 2, like any other bad argument
    spark = spark or SparkSession.builder.getOrCreate()
    try:
        if args.command == "stage":
            with open(args.jdbc_options) as fh:
                options = json.load(fh)
            rep = stage_from_jdbc(spark, options, args.table, args.stg_root, args.etl_date,
                                  partition_column=args.partition_column, num_partitions=args.num_partitions,
                                  single_connection=args.single_connection, source_table=args.source_table)
            print(f"staged {rep.table}: {rep.snapshot_rows} rows at {rep.path}")
        else:
            quarantine = f"{args.quarantine_root.rstrip('/')}/{args.entity}" if args.quarantine_root else None
            hidden = [c for c in ("card_number", "cvv") if args.entity == "mdm_cards"]
            if args.preview_source:
                entity = ENTITIES[args.entity]
                staged = read_snapshot(spark, f"{args.stg_root.rstrip('/')}/{entity.source_table}", args.etl_date)
                for row in staged.select(*entity.required).drop(*hidden).limit(args.preview_source).collect():
                    print(row)
            rep = process_snapshot(spark, args.entity, args.stg_root, args.prc_root, args.etl_date, quarantine_root=quarantine,
                                   files=args.files, persist_source=args.persist_source, offender_sample=args.offenders)
            _print_offenders(rep.offenders)
            for w in rep.warnings:
                print(f"warning: {w}")
            print(f"published {rep.entity}: {rep.written_rows} rows at {rep.path}")
            if args.preview:
                for row in spark.read.parquet(rep.path).drop(*hidden).limit(args.preview).collect():
                    print(row)
    except (QualityGateError, PublishError, ReconcileError, SnapshotError) as err:
        if isinstance(err, QualityGateError):
            _print_offenders(err.result.offenders)
        print(f"failed: {err}", file=sys.stderr)
        return 1
    return 0
