"""Transaction fact mapping (E2): one output row per source row, map-only
(no shuffle). The merchant key is the same function the merchant dimension
uses, and the MCC is normalised like the MCC dimension, so the fact joins to
both."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.functions import clean_money, merchant_key, normalize_mcc, transaction_method
from mdmspark.plans import schemas
from mdmspark.plans.entity import Entity

REQUIRED = (
    "id", "date", "client_id", "card_id", "amount", "use_chip",
    "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "errors",
)


def project(src: DataFrame) -> list[Column]:
    c = F.col
    return [
        c("id").try_cast("long").alias("transactions_id"),
        c("date").try_cast("timestamp").alias("transaction_datetime"),
        c("client_id").try_cast("long").alias("client_id"),
        c("card_id").try_cast("long").alias("card_id"),
        clean_money(c("amount"), src.schema["amount"].dataType).alias("transaction_amount"),
        transaction_method(c("use_chip")).alias("transaction_method"),
        merchant_key(c("merchant_id"), c("merchant_city"), c("merchant_state"), c("zip")).alias("merchant_key"),
        c("merchant_id").try_cast("long").alias("merchant_id"),
        normalize_mcc(c("mcc")).alias("mcc"),
        c("errors").cast("string").alias("errors"),
    ]


ENTITY = Entity(
    name="mdm_sub_transactions",
    source_table="transactions",
    required=REQUIRED,
    schema=schemas.SUB_TRANSACTIONS,
    project=project,
)


def build_sub_transactions(src: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    return ENTITY.build(src, load_ts)
