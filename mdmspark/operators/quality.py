"""Quality rules, one-pass metrics, gates and quarantine (A1-A4, A6, W*, Q*).

A rule is data: a name, a predicate that is true on an offending row, and a
severity. All rules of an entity are counted in **one** aggregation
(``count_if`` per rule) instead of one ``filter().count()`` job per rule;
key rules (duplicates, several values per key, no usable value per key) and
the counts themselves come from the per-key summary in
:mod:`mdmspark.operators.summary`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdmspark.operators.fingerprint import row_text

WARN = "warn"
ERROR = "error"

ROWS = "n_rows"
KEYS = "n_keys"


@dataclass
class Rule:
    """Row rule: ``predicate`` is true on an offending row (NULL counts as
    not offending)."""

    name: str
    predicate: Column
    severity: str = WARN
    description: str = ""

    def offends(self) -> Column:
        return F.coalesce(self.predicate, F.lit(False))


@dataclass
class KeyRule:
    """Rule over the rows sharing a key.

    kinds: ``duplicate`` - a non-NULL key on more than one row;
    ``conflict`` - more than one distinct non-NULL ``value`` per key;
    ``none_present`` - no row of the key satisfies ``value`` (a boolean).
    """

    name: str
    kind: str
    value: Column | None = None
    severity: str = WARN
    description: str = ""


@dataclass
class GateResult:
    metrics: dict
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    offenders: list[dict] = field(default_factory=list)
    """a sample of the offending rows of each rule, if asked for"""


class QualityGateError(RuntimeError):
    """An error-severity rule fired; nothing was written."""

    def __init__(self, entity: str, result: GateResult):
        self.entity = entity
        self.result = result
        super().__init__(f"{entity}: quality gate failed: " + "; ".join(result.errors))


def evaluate(metrics: Mapping[str, int], rules: Sequence[Rule | KeyRule]) -> GateResult:
    """Sort fired rules into warnings and errors, in rule order."""
    result = GateResult(metrics=dict(metrics))
    for r in rules:
        n = metrics.get(r.name) or 0
        if n > 0:
            msg = f"{r.name}={n}" + (f" ({r.description})" if r.description else "")
            (result.errors if r.severity == ERROR else result.warnings).append(msg)
    return result


def enforce(entity: str, metrics: Mapping[str, int], rules: Sequence[Rule | KeyRule]) -> GateResult:
    """Raise :class:`QualityGateError` when any error rule fired."""
    result = evaluate(metrics, rules)
    if result.errors:
        raise QualityGateError(entity, result)
    return result


def quarantine(df: DataFrame, rules: Sequence[Rule], columns: Sequence[str | Column]) -> DataFrame:
    """Every offending row once per rule it breaks: ``rule``, ``severity`` and
    ``columns``. One scan for all rules; the full set is kept (display code
    may ``limit`` it, the quarantine itself is never sampled). Leave
    sensitive columns (card number, cvv) out of ``columns``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if not rules:
        none = F.lit(None).cast("string")
        return df.select(none.alias("rule"), none.alias("severity"), *cols).where(F.lit(False))
    tags = F.array_compact(
        F.array(*[
            F.when(r.offends(), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity")))
            for r in rules
        ])
    )
    hits = df.select(F.explode(tags).alias("_hit"), *cols)
    return hits.select(
        F.col("_hit.rule").alias("rule"),
        F.col("_hit.severity").alias("severity"),
        *[F.col(f"`{c}`") for c in hits.columns if c != "_hit"],
    )


def sample_offenders(hits: DataFrame, n: int = 20, by: str = "rule") -> DataFrame:
    """``n`` rows of each rule of a quarantine (L2): those whose md5 is lowest,
    so the sample is the same at every run and order, and even over the rows.

    Each task cuts its rows to ``n`` a rule before the shuffle (a group limit
    below the exchange), so at most ``n`` rows a task and rule move, even if
    every row offends."""
    if n < 1:
        raise ValueError("n must be >= 1")
    order = Window.partitionBy(by).orderBy("_hash", *[F.col(f"`{c}`") for c in hits.columns])
    ranked = hits.withColumn("_hash", F.md5(row_text(hits))).withColumn("_place", F.row_number().over(order))
    return ranked.where(F.col("_place") <= n).drop("_hash", "_place")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required source columns absent from ``df`` (Q1); analysis only, no job."""
    present = set(df.columns)
    return sorted(c for c in required if c not in present)


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: Sequence[str], entity: str = "") -> None:
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(f"{entity}: missing required columns {missing}")
