"""User dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.functions import COORDINATE, clean_money, clean_text, gender_code, title_text, to_decimal
from mdmspark.functions.constants import CURRENCY_CODE
from mdmspark.operators.quality import ERROR, WARN, KeyRule, Rule
from mdmspark.plans import schemas
from mdmspark.plans.entity import Entity

# Fixed column contract of the source table.
REQUIRED = (
    "id", "current_age", "birth_year", "birth_month", "gender", "address", "latitude", "longitude",
    "per_capita_income", "yearly_income", "total_debt", "credit_score", "num_credit_cards",
)


def source_key() -> Column:
    return F.col("id").try_cast("long")


def project(src: DataFrame) -> list[Column]:
    c = F.col

    def money(name: str) -> Column:
        return clean_money(c(name), src.schema[name].dataType)

    return [
        source_key().alias("user_id"),
        c("current_age").try_cast("int").alias("current_age"),
        c("birth_year").try_cast("int").alias("birth_year"),
        c("birth_month").try_cast("int").alias("birth_month"),
        title_text(c("gender")).alias("gender_text"),
        gender_code(c("gender")).alias("gender"),
        clean_text(c("address")).alias("address"),
        to_decimal(c("latitude"), COORDINATE).alias("latitude"),
        to_decimal(c("longitude"), COORDINATE).alias("longitude"),
        money("per_capita_income").alias("per_capita_income"),
        money("yearly_income").alias("year_income"),
        F.lit(CURRENCY_CODE).alias("currency_code"),
        money("total_debt").alias("total_debt"),
        c("credit_score").try_cast("int").alias("credit_score"),
        c("num_credit_cards").try_cast("int").alias("number_credit_cards"),
    ]


def rules() -> list[Rule]:
    return [Rule("user_id_null", source_key().isNull(), ERROR, "user id is NULL")]


def key_rules() -> list[KeyRule]:
    return [KeyRule("duplicate_user_id", "duplicate", None, WARN, "user id on several source rows")]


ENTITY = Entity(
    name="mdm_users",
    source_table="users",
    required=REQUIRED,
    schema=schemas.USERS,
    project=project,
    key="user_id",
    source_key=source_key,
    rules=rules,
    key_rules=key_rules,
    quarantine_columns=("id", "gender", "yearly_income"),
)


def build_users(src: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    return ENTITY.build(src, load_ts)
