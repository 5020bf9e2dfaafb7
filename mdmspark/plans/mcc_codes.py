"""Merchant category code dimension.

Codes are normalised to four digits; a code that is not one to four digits
is an error (checked on the raw text, so '12345' is rejected rather than cut
to '1234'). Descriptions are trimmed and cut to 1000 characters. Per code the
kept description is the lowest present one (a NULL or blank description
loses to any other), so a code publishes NULL only when it has no
description at all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.functions import bounded_text, clean_text, is_present, mcc_is_valid, normalize_mcc, too_long
from mdmspark.operators.quality import ERROR, WARN, KeyRule, Rule
from mdmspark.plans import schemas
from mdmspark.plans.entity import Entity

REQUIRED = ("mcc_id", "description")


def source_key() -> Column:
    return normalize_mcc(F.col("mcc_id"))


def project(src: DataFrame) -> list[Column]:
    return [
        source_key().alias("mcc_id"),
        bounded_text(F.col("description")).alias("description"),
    ]


def rules() -> list[Rule]:
    return [
        Rule("mcc_invalid", ~mcc_is_valid(F.col("mcc_id")), ERROR, "mcc_id is not 1-4 digits"),
        Rule("description_too_long", too_long(F.col("description")), WARN, "description cut to 1000 characters"),
    ]


def key_rules() -> list[KeyRule]:
    return [
        KeyRule("description_conflict", "conflict", clean_text(F.col("description")), ERROR,
                "mcc_id with several descriptions"),
        KeyRule("description_missing", "none_present", is_present(F.col("description")), WARN,
                "mcc_id without a description"),
    ]


ENTITY = Entity(
    name="mdm_mcc_codes",
    source_table="mcc_codes",
    required=REQUIRED,
    schema=schemas.MCC_CODES,
    project=project,
    key="mcc_id",
    source_key=source_key,
    rules=rules,
    key_rules=key_rules,
    keep=lambda: mcc_is_valid(F.col("mcc_id")),
    prefer_present=("description",),
    quarantine_columns=("mcc_id", "description"),
)


def build_mcc_codes(src: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    return ENTITY.build(src, load_ts)
