"""Merchant dimension (E3), derived from the transactions.

Billions of transactions map onto comparatively few merchants. Publishing
reads the transactions once (five columns) and aggregates per merchant key
once: the kept row, the row count and the collision check (``min`` and
``max`` of the natural key differ) in one partial-then-final aggregation,
so each map task ships at most one row per merchant. The lowest tuple wins (NULLs first), so the pick is
the same on every run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.functions import clean_text, location_type, merchant_key, natural_key_text, upper_text
from mdmspark.operators.quality import ERROR, KeyRule, Rule
from mdmspark.plans import schemas
from mdmspark.plans.entity import Entity

REQUIRED = ("merchant_id", "merchant_city", "merchant_state", "zip", "use_chip")
KEY_PARTS = ("merchant_id", "merchant_city", "merchant_state", "zip")


def source_key() -> Column:
    return merchant_key(*[F.col(p) for p in KEY_PARTS])


def natural_key() -> Column:
    """The raw text behind the key (what is hashed)."""
    return natural_key_text(*[F.col(p) for p in KEY_PARTS])


def project(src: DataFrame) -> list[Column]:
    c = F.col
    return [
        source_key().alias("merchant_key"),
        c("merchant_id").cast("string").alias("merchant_id"),
        clean_text(c("merchant_city")).alias("merchant_city"),
        upper_text(c("merchant_state")).alias("merchant_state"),
        c("zip").cast("string").alias("zip"),
        location_type(c("use_chip"), c("merchant_city")).alias("location_type"),
    ]


def rules() -> list[Rule]:
    return [Rule("merchant_key_null", source_key().isNull(), ERROR, "merchant key is NULL")]


def key_rules() -> list[KeyRule]:
    return [KeyRule("merchant_key_collision", "conflict", natural_key(), ERROR,
                    "one merchant key carries several natural keys")]


ENTITY = Entity(
    name="mdm_merchant",
    source_table="transactions",
    required=REQUIRED,
    schema=schemas.MERCHANT,
    project=project,
    key="merchant_key",
    source_key=source_key,
    rules=rules,
    key_rules=key_rules,
    quarantine_columns=KEY_PARTS,
)


def build_merchant(src: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    return ENTITY.build(src, load_ts)
