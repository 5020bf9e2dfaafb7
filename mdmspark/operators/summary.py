"""Per-key summary: de-duplication and every quality metric in one
aggregation.

For each key one row holds: the kept row (the lowest ranking struct, as in
:func:`mdmspark.operators.dedup.dedup`), the number of source rows, the
count of each row rule, and what the key rules need - ``min``/``max`` of a
value (more than one distinct non-NULL value exactly when ``min < max``) and
``bool_or`` of a presence flag. The aggregation is partial per map task,
then one exchange on the key, so a hot key ships one row per task.

From the summary, the one-row metrics frame (:func:`summary_metrics`), the
de-duplicated rows (:func:`summary_rows`) and the keys that break a key rule
(:func:`offending_keys`) are cheap projections: a publish job scans its source
once and shuffles once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.operators.dedup import ranking_fields
from mdmspark.operators.quality import KEYS, ROWS, KeyRule, Rule

BEST = "_best"
COUNT = "_n"
KEEP = "_keep"


def _value(i: int) -> str:
    return f"_kv{i}"


def summary_inputs(rules: Sequence[Rule] = (), key_rules: Sequence[KeyRule] = (),
                   keep: Column | None = None) -> list[Column]:
    """The per-row columns :func:`summarize` reads: one flag per row rule,
    the value of each key rule, and the keep flag. Select them next to the
    output columns, in the same projection over the source rows."""
    cols = [r.offends().alias(f"_r{i}") for i, r in enumerate(rules)]
    cols += [kr.value.alias(_value(i)) for i, kr in enumerate(key_rules) if kr.value is not None]
    cols.append((F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))).alias(KEEP))
    return cols


def summarize(
    wide: DataFrame,
    key: str,
    columns: Sequence[str],
    rules: Sequence[Rule] = (),
    key_rules: Sequence[KeyRule] = (),
    order: Sequence[str] | None = None,
    prefer_present: Sequence[str] = (),
) -> DataFrame:
    """One row per key of ``wide`` (a NULL key is one group).

    ``wide`` holds the output ``columns`` (``key`` among them) and the
    :func:`summary_inputs` of the same rules. Only kept rows compete for the
    kept row; a key without such rows has a NULL ``_best``.
    """
    rest = [c for c in columns if c != key]
    fields, _ = ranking_fields(rest, order, prefer_present)
    struct = f"named_struct({', '.join(fields)})" if fields else "named_struct('_v0', 0)"
    aggs = [
        F.expr(f"min(CASE WHEN {KEEP} THEN {struct} END)").alias(BEST),
        F.count(F.lit(1)).alias(COUNT),
    ]
    aggs += [F.count_if(F.col(f"_r{i}")).alias(r.name) for i, r in enumerate(rules)]
    for i, kr in enumerate(key_rules):
        if kr.kind == "conflict":
            aggs += [F.min(_value(i)).alias(f"_lo{i}"), F.max(_value(i)).alias(f"_hi{i}")]
        elif kr.kind == "none_present":
            aggs.append(F.bool_or(F.coalesce(F.col(_value(i)), F.lit(False))).alias(f"_any{i}"))
        elif kr.kind != "duplicate":
            raise ValueError(f"unknown key rule kind: {kr.kind}")
    return wide.groupBy(key).agg(*aggs)


def breaks(key_rule: KeyRule, i: int, key: str) -> Column:
    """Whether a summary row's key breaks the ``i``-th key rule."""
    if key_rule.kind == "duplicate":
        return F.col(key).isNotNull() & (F.col(COUNT) > 1)
    if key_rule.kind == "conflict":
        return F.coalesce(F.col(f"_lo{i}") < F.col(f"_hi{i}"), F.lit(False))
    return ~F.col(f"_any{i}")


def offending_keys(summary: DataFrame, key: str, key_rules: Sequence[KeyRule], names: Sequence[str]) -> DataFrame:
    """``(rule, severity, key)`` for every key that breaks one of the key rules named."""
    tags = [F.when(breaks(kr, i, key), F.struct(F.lit(kr.name).alias("rule"), F.lit(kr.severity).alias("severity")))
            for i, kr in enumerate(key_rules) if kr.name in names]
    return summary.select(key, F.explode(F.array_compact(F.array(*tags))).alias("_hit")).select("_hit.rule", "_hit.severity", key)


def summary_metrics(summary: DataFrame, key: str, rules: Sequence[Rule] = (),
                    key_rules: Sequence[KeyRule] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """The one-row metrics of the rows behind ``summary``: ``n_rows``,
    ``n_keys`` and one count per rule (and ``extra`` aggregates)."""
    out = [
        F.coalesce(F.sum(COUNT), F.lit(0)).cast("long").alias(ROWS),
        F.count(F.lit(1)).alias(KEYS),
    ]
    out += [F.coalesce(F.sum(r.name), F.lit(0)).cast("long").alias(r.name) for r in rules]
    out += [F.count_if(breaks(kr, i, key)).alias(kr.name) for i, kr in enumerate(key_rules)]
    return summary.agg(*out, *extra)


def kept_keys() -> Column:
    """How many keys of a summary have a row to publish."""
    return F.count_if(F.col(BEST).isNotNull())


def quality_metrics(
    df: DataFrame,
    rules: Sequence[Rule] = (),
    key: Column | None = None,
    key_rules: Sequence[KeyRule] = (),
) -> DataFrame:
    """One row: ``n_rows``, ``n_keys`` (when a key is given) and one count per
    rule. One job; with a key, one shuffle pre-aggregated per key."""
    if key is None:
        if key_rules:
            raise ValueError("key rules need a key")
        return df.agg(
            F.count(F.lit(1)).alias(ROWS),
            *[F.count_if(r.offends()).alias(r.name) for r in rules],
        )
    wide = df.select(key.alias("_key"), *summary_inputs(rules, key_rules))
    return summary_metrics(summarize(wide, "_key", ["_key"], rules, key_rules), "_key", rules, key_rules)


def summary_rows(summary: DataFrame, key: str, columns: Sequence[str],
                 order: Sequence[str] | None = None, prefer_present: Sequence[str] = ()) -> DataFrame:
    """The kept row of every key that has one, in ``columns`` order."""
    rest = [c for c in columns if c != key]
    _, slot = ranking_fields(rest, order, prefer_present)
    return summary.where(F.col(BEST).isNotNull()).selectExpr(
        *[f"`{key}`" if c == key else f"{BEST}.{slot[c]} AS `{c}`" for c in columns]
    )
