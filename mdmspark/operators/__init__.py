"""DataFrame -> DataFrame operators: deterministic de-duplication, key
profiling, quality metrics / gates / quarantine."""

from mdmspark.operators.dedup import dedup
from mdmspark.operators.fingerprint import Fingerprint, fingerprint, fingerprint_table
from mdmspark.operators.profiling import bounded_sets, duplicate_keys, value_conflicts
from mdmspark.operators.summary import offending_keys, quality_metrics, summarize, summary_inputs, summary_metrics, summary_rows
from mdmspark.operators.quality import (
    ERROR,
    WARN,
    GateResult,
    KeyRule,
    MissingColumnsError,
    QualityGateError,
    Rule,
    enforce,
    evaluate,
    missing_columns,
    quarantine,
    require_columns,
    sample_offenders,
)
from mdmspark.operators.scope import FrameScope

__all__ = [
    "ERROR",
    "WARN",
    "Fingerprint",
    "FrameScope",
    "GateResult",
    "KeyRule",
    "MissingColumnsError",
    "QualityGateError",
    "Rule",
    "bounded_sets",
    "dedup",
    "duplicate_keys",
    "enforce",
    "evaluate",
    "fingerprint",
    "fingerprint_table",
    "missing_columns",
    "offending_keys",
    "quality_metrics",
    "quarantine",
    "require_columns",
    "sample_offenders",
    "summarize",
    "summary_inputs",
    "summary_metrics",
    "summary_rows",
    "value_conflicts",
]
