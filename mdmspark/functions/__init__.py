"""Column -> Column builders. All are built-in Spark expressions (no UDF), so
they run inside whole-stage codegen and behave the same with ANSI on or off."""

from mdmspark.functions.codes import (
    chip_flag,
    gender_code,
    location_type,
    mcc_is_valid,
    mcc_text,
    normalize_mcc,
    transaction_method,
)
from mdmspark.functions.dates import is_present, parse_flexible_date, unparseable_date
from mdmspark.functions.keys import merchant_key, natural_key_text, surrogate_key
from mdmspark.functions.money import COORDINATE, MONEY, clean_money, strip_money_text, to_decimal
from mdmspark.functions.text import bounded_text, clean_text, is_blank, title_text, too_long, upper_text

__all__ = [
    "COORDINATE",
    "MONEY",
    "bounded_text",
    "chip_flag",
    "clean_money",
    "clean_text",
    "gender_code",
    "is_blank",
    "is_present",
    "location_type",
    "mcc_is_valid",
    "mcc_text",
    "merchant_key",
    "natural_key_text",
    "normalize_mcc",
    "parse_flexible_date",
    "strip_money_text",
    "surrogate_key",
    "title_text",
    "to_decimal",
    "too_long",
    "transaction_method",
    "unparseable_date",
    "upper_text",
]
