"""Card dimension (E5).

The card number and cvv are published as the source has them (trimmed);
they are never part of a quarantine.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.functions import chip_flag, clean_money, clean_text, is_present, parse_flexible_date, upper_text
from mdmspark.operators.quality import ERROR, WARN, KeyRule, Rule
from mdmspark.plans import schemas
from mdmspark.plans.entity import Entity

# Fixed column contract of the source table.
REQUIRED = (
    "id", "client_id", "card_type", "card_brand", "card_number", "expires", "cvv", "has_chip",
    "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed",
)
SENSITIVE = ("card_number", "cvv")


def source_key() -> Column:
    return F.col("id").try_cast("long")


def prepare(src: DataFrame) -> DataFrame:
    """Both dates parsed once, for the output and for the rules."""
    return src.withColumns({
        "_expires": parse_flexible_date(F.col("expires")),
        "_acct_open_date": parse_flexible_date(F.col("acct_open_date")),
    })


def project(src: DataFrame) -> list[Column]:
    c = F.col
    return [
        source_key().alias("card_id"),
        c("client_id").try_cast("long").alias("client_id"),
        upper_text(c("card_type")).alias("card_type"),
        upper_text(c("card_brand")).alias("card_brand"),
        clean_text(c("card_number")).alias("card_number"),
        F.last_day("_expires").alias("expires"),
        clean_text(c("cvv")).alias("cvv"),
        chip_flag(c("has_chip")).alias("has_chip"),
        c("num_cards_issued").try_cast("int").alias("num_cards_issued"),
        clean_money(c("credit_limit"), src.schema["credit_limit"].dataType).alias("credit_limit"),
        c("_acct_open_date").alias("acct_open_date"),
        c("year_pin_last_changed").try_cast("int").alias("year_pin_last_changed"),
    ]


def rules() -> list[Rule]:
    c = F.col
    return [
        Rule("card_id_null", source_key().isNull(), ERROR, "card id is NULL"),
        Rule("expires_unparseable", is_present(c("expires")) & c("_expires").isNull(), WARN, "expires present but not a date"),
        Rule("acct_open_date_unparseable", is_present(c("acct_open_date")) & c("_acct_open_date").isNull(), WARN,
             "acct_open_date present but not a date"),
        Rule("client_id_null", c("client_id").try_cast("long").isNull(), WARN, "client id is NULL"),
        Rule("chip_flag_unknown", chip_flag(c("has_chip")).isNull(), WARN, "has_chip is not a yes/no value"),
    ]


def key_rules() -> list[KeyRule]:
    return [KeyRule("duplicate_card_id", "duplicate", None, WARN, "card id on several source rows")]


ENTITY = Entity(
    name="mdm_cards",
    source_table="cards",
    required=REQUIRED,
    schema=schemas.CARDS,
    project=project,
    prepare=prepare,
    key="card_id",
    source_key=source_key,
    rules=rules,
    key_rules=key_rules,
    quarantine_columns=("id", "client_id", "expires", "has_chip", "acct_open_date"),
)


def build_cards(src: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    return ENTITY.build(src, load_ts)
