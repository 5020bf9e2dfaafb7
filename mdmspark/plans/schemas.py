"""Target schemas of the published tables, in output order."""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_MONEY = DecimalType(18, 2)
_COORD = DecimalType(10, 6)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SUB_TRANSACTIONS = _schema(
    ("transactions_id", LongType()),
    ("transaction_datetime", TimestampType()),
    ("client_id", LongType()),
    ("card_id", LongType()),
    ("transaction_amount", _MONEY),
    ("transaction_method", StringType()),
    ("merchant_key", LongType()),
    ("merchant_id", LongType()),
    ("mcc", StringType()),
    ("errors", StringType()),
    ("etl_date", TimestampType()),
)

MERCHANT = _schema(
    ("merchant_key", LongType()),
    ("merchant_id", StringType()),
    ("merchant_city", StringType()),
    ("merchant_state", StringType()),
    ("zip", StringType()),
    ("location_type", StringType()),
    ("etl_date", TimestampType()),
)

USERS = _schema(
    ("user_id", LongType()),
    ("current_age", IntegerType()),
    ("birth_year", IntegerType()),
    ("birth_month", IntegerType()),
    ("gender_text", StringType()),
    ("gender", IntegerType()),
    ("address", StringType()),
    ("latitude", _COORD),
    ("longitude", _COORD),
    ("per_capita_income", _MONEY),
    ("year_income", _MONEY),
    ("currency_code", StringType()),
    ("total_debt", _MONEY),
    ("credit_score", IntegerType()),
    ("number_credit_cards", IntegerType()),
    ("etl_date", TimestampType()),
)

CARDS = _schema(
    ("card_id", LongType()),
    ("client_id", LongType()),
    ("card_type", StringType()),
    ("card_brand", StringType()),
    ("card_number", StringType()),
    ("expires", DateType()),
    ("cvv", StringType()),
    ("has_chip", IntegerType()),
    ("num_cards_issued", IntegerType()),
    ("credit_limit", _MONEY),
    ("acct_open_date", DateType()),
    ("year_pin_last_changed", IntegerType()),
    ("etl_date", TimestampType()),
)

MCC_CODES = _schema(
    ("mcc_id", StringType()),
    ("description", StringType()),
    ("etl_date", TimestampType()),
)
