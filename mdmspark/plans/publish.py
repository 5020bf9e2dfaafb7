"""Publishing an entity: check -> gate -> write (E2-E6 end to end).

Per run of a keyed entity: the source is scanned once and shuffled once, by
the per-key summary (kept row, row count and every rule's inputs in one
aggregation, partial per map task). The summary is kept; the metrics job
reads it, the gate decides, and the write projects the kept rows from it
while observing the written count. Error rules are decided **before** the
write, so a failed gate leaves the previous snapshot of that date untouched;
offending rows go to the quarantine (an extra scan, and a join with the
offending keys where a key rule fired). The fact mapping has no key: a footer-only count, then a map-only
write.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from mdmspark.operators.quality import KEYS, ROWS, QualityGateError, enforce, sample_offenders
from mdmspark.operators.scope import FrameScope
from mdmspark.plans import cards, mcc_codes, merchant, sub_transactions, users
from mdmspark.plans.entity import Entity
from mdmspark.sinks.files import FILE_BYTES, size_files, write_snapshot
from mdmspark.sources.files import SNAPSHOT_COLUMN, parse_snapshot_date, read_snapshot, snapshot_path
from mdmspark.sources.manifest import Store, read_manifest

ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (sub_transactions.ENTITY, merchant.ENTITY, users.ENTITY, cards.ENTITY, mcc_codes.ENTITY)
}


_KEPT = "_kept"


class PublishError(RuntimeError):
    """The rows to publish, or the rows written, are not one per key."""


@dataclass
class PublishReport:
    entity: str
    snapshot_date: dt.date
    path: str
    metrics: dict
    warnings: list[str] = field(default_factory=list)
    written_rows: int = 0
    offenders: list[dict] = field(default_factory=list)


def publish_entity(
    entity: Entity,
    source: DataFrame,
    target_root: str,
    snapshot_date: str | dt.date,
    load_ts: dt.datetime | None = None,
    files: int | None = None,
    persist_source: bool = False,
    quarantine_root: str | None = None,
    offender_sample: int = 0,
    source_bytes: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> PublishReport:
    """Check ``source``, and when no error rule fires write the entity's
    ``snapshot_date`` snapshot under ``target_root``.

    Raises :class:`mdmspark.operators.quality.QualityGateError` or
    :class:`PublishError` (a key without a row to publish) before anything is
    written. With ``quarantine_root`` the offending rows of every rule that
    fired, key rules included, replace that date's quarantine (an empty one if
    none fired), before the gate decides. With ``offender_sample`` the report,
    or the error, carries so many offending rows of each rule that fired. With
    ``source_bytes``, the size of the source's files, the files of a table
    without a key are planned to hold about ``file_bytes`` each.
    Frames persisted on the way are released on every way out.
    """
    d = parse_snapshot_date(snapshot_date)
    entity.check_columns(source)
    with FrameScope() as frames:
        src = frames.keep(source.select(*entity.required), persist_source)
        summary = None
        if entity.key is None:
            # a plain row count, read from Parquet footers
            metrics = entity.metrics(src).first().asDict()
        else:
            # one scan and one shuffle: the per-key summary serves the
            # metrics job and the write, kept in between
            summary = frames.keep(entity.summary(src))
            metrics = entity.summary_metrics(summary, _KEPT).first().asDict()
        kept = metrics.pop(_KEPT, metrics[ROWS])
        sample = []
        if quarantine_root is not None:
            write_snapshot(_offenders(entity, src, summary, metrics), quarantine_root, d)
        if offender_sample and any(metrics.get(r.name, 0) > 0 for r in entity.all_rules()):
            found = _offenders(entity, src, summary, metrics) if quarantine_root is None else (
                read_snapshot(src.sparkSession, quarantine_root, d).drop(SNAPSHOT_COLUMN))
            # at most offender_sample rows a rule
            sample = [r.asDict() for r in sample_offenders(found, offender_sample).collect()]
        try:
            result = enforce(entity.name, metrics, entity.all_rules())
        except QualityGateError as err:
            err.result.offenders = sample
            raise
        expected = metrics[KEYS] if entity.key is not None else metrics[ROWS]
        if kept != expected:
            raise PublishError(f"{entity.name}: expected {expected} rows, have {kept}")

        if summary is None:
            out = entity.build(src, load_ts)
            if files is None and source_bytes is not None:
                out = size_files(out, source_bytes, file_bytes)
        else:
            out = entity.build_from_summary(summary, load_ts)
            if files is None:
                # Spark sizes the files by bytes; one shuffle of the kept rows
                out = out.hint("rebalance")
        written = write_snapshot(out, target_root, d, files=files)
        if written != expected:
            raise PublishError(f"{entity.name}: expected {expected} rows, wrote {written}")
        return PublishReport(entity.name, d, snapshot_path(target_root, d), metrics, result.warnings, written, sample)


def _offenders(entity: Entity, src: DataFrame, summary: DataFrame | None, metrics: dict) -> DataFrame:
    """The offending rows of every rule that fired, one per row and rule."""
    fired = [r for r in entity.rules() if metrics.get(r.name, 0) > 0]
    out = entity.quarantine(src, fired)
    names = [k.name for k in entity.key_rules() if metrics.get(k.name, 0) > 0]
    return out.unionByName(entity.key_quarantine(src, summary, names)) if names else out


def process_snapshot(
    spark: SparkSession,
    entity_name: str,
    stg_root: str,
    prc_root: str,
    snapshot_date: str | dt.date,
    **kwargs,
) -> PublishReport:
    """The processing job of one entity: read the staged source snapshot at
    ``stg_root/<source table>`` and publish ``prc_root/<entity>``."""
    entity = ENTITIES[entity_name]
    root = f"{stg_root.rstrip('/')}/{entity.source_table}"
    source = read_snapshot(spark, root, snapshot_date)
    manifest = read_manifest(Store(spark, root), snapshot_path(root, snapshot_date))
    if manifest is not None:
        kwargs.setdefault("source_bytes", sum(manifest.files.values()))
    return publish_entity(entity, source, f"{prc_root.rstrip('/')}/{entity.name}", snapshot_date, **kwargs)
