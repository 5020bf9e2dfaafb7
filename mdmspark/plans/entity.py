"""An entity pipeline as data: how to project a staged source into the target
table, its key, how to de-duplicate, and which rules guard publication."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mdmspark.operators.dedup import dedup
from mdmspark.operators.quality import KeyRule, Rule, quarantine, require_columns
from mdmspark.operators.summary import (
    kept_keys,
    offending_keys,
    quality_metrics,
    summarize,
    summary_inputs,
    summary_metrics,
    summary_rows,
)

LOAD_COLUMN = "etl_date"


def load_timestamp(load_ts: dt.datetime | None = None) -> Column:
    """The load-time column. Pass ``load_ts`` to make a run repeatable; by
    default the driver's clock is read once, so every row of a run carries
    the same value."""
    ts = load_ts if load_ts is not None else dt.datetime.now()
    return F.lit(ts).cast("timestamp")


@dataclass(frozen=True)
class Entity:
    name: str
    source_table: str
    required: tuple[str, ...]
    schema: StructType
    project: Callable[[DataFrame], list[Column]]
    """the target columns but ``etl_date``, as expressions over a source row"""
    key: str | None = None
    source_key: Callable[[], Column] | None = None
    """the key computed from source columns, for the quality metrics"""
    rules: Callable[[], list[Rule]] = lambda: []
    key_rules: Callable[[], list[KeyRule]] = lambda: []
    keep: Callable[[], Column] | None = None
    """rows that may be published (others are reported by an error rule)"""
    order: tuple[str, ...] | None = None
    prefer_present: tuple[str, ...] = ()
    prepare: Callable[[DataFrame], DataFrame] = lambda src: src
    """adds columns that several expressions of ``project`` and ``rules`` share"""
    quarantine_columns: tuple[str, ...] = ()

    def check_columns(self, source: DataFrame) -> None:
        require_columns(source, self.required, self.name)

    @property
    def columns(self) -> list[str]:
        """Target columns but the load timestamp."""
        return [f.name for f in self.schema.fields if f.name != LOAD_COLUMN]

    def mapped(self, source: DataFrame) -> DataFrame:
        """Projected rows before de-duplication."""
        self.check_columns(source)
        src = self.prepare(source if self.keep is None else source.where(self.keep()))
        return src.select(*self.project(src))

    def _finish(self, rows: DataFrame, load_ts: dt.datetime | None) -> DataFrame:
        out = rows.withColumn(LOAD_COLUMN, load_timestamp(load_ts))
        return out.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                                for f in self.schema.fields])

    def build(self, source: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
        """The publishable table: projected, de-duplicated on the key, with
        the load timestamp, in target column order. Lazy; no job runs."""
        out = self.mapped(source)
        if self.key is not None:
            out = dedup(out, self.key, order=self.order, prefer_present=self.prefer_present)
        return self._finish(out, load_ts)

    def all_rules(self) -> list[Rule | KeyRule]:
        return [*self.rules(), *self.key_rules()]

    def metrics(self, source: DataFrame) -> DataFrame:
        """One-row quality metrics over the source rows (before the keep
        filter and before de-duplication, so NULL keys are counted)."""
        if self.key is not None:
            return self.summary_metrics(self.summary(source))
        self.check_columns(source)
        return quality_metrics(self.prepare(source), self.rules())

    # -- one scan, one shuffle: the per-key summary ---------------------------

    def summary(self, source: DataFrame) -> DataFrame:
        """Per-key summary of the source (see :mod:`mdmspark.operators.summary`):
        the kept row, the row count and every rule's inputs, from one
        aggregation. :meth:`summary_metrics` and :meth:`build_from_summary`
        read it; persist it when both run."""
        if self.key is None:
            raise ValueError(f"{self.name} has no key")
        self.check_columns(source)
        keep = self.keep() if self.keep is not None else None
        src = self.prepare(source)
        wide = src.select(*self.project(src), *summary_inputs(self.rules(), self.key_rules(), keep))
        return summarize(wide, self.key, self.columns, self.rules(), self.key_rules(), self.order,
                         self.prefer_present)

    def summary_metrics(self, summary: DataFrame, kept: str | None = None) -> DataFrame:
        """The same one-row frame as :meth:`metrics`, from a summary; with
        ``kept`` also the number of rows to publish, under that name."""
        extra = [kept_keys().alias(kept)] if kept else []
        return summary_metrics(summary, self.key, self.rules(), self.key_rules(), extra)

    def build_from_summary(self, summary: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
        """The same table as :meth:`build`, from a summary (no shuffle)."""
        rows = summary_rows(summary, self.key, self.columns, self.order, self.prefer_present)
        return self._finish(rows, load_ts)

    def quarantine(self, source: DataFrame, rules: list[Rule] | None = None,
                   extra_columns: Sequence[str] = ()) -> DataFrame:
        """Offending source rows, one per broken row rule (all row rules, or
        the given ones)."""
        self.check_columns(source)
        cols = list(self.quarantine_columns or self.required) + list(extra_columns)
        return quarantine(self.prepare(source), self.rules() if rules is None else rules, cols)

    def key_quarantine(self, source: DataFrame, summary: DataFrame, names: Sequence[str]) -> DataFrame:
        """Every source row of a key that breaks one of the key rules named,
        once per rule, in the columns of :meth:`quarantine`."""
        keys = offending_keys(summary, self.key, self.key_rules(), names).withColumnRenamed(self.key, "_bad")
        rows = source.select(self.source_key().alias("_key"), *(self.quarantine_columns or self.required))
        hits = rows.join(keys, F.col("_key").eqNullSafe(F.col("_bad")))
        return hits.select("rule", "severity", *(self.quarantine_columns or self.required))
