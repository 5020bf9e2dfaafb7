"""Money and fixed-point columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NumericType

from mdmspark.functions.constants import (
    COORDINATE_PRECISION,
    COORDINATE_SCALE,
    MONEY_PRECISION,
    MONEY_SCALE,
    MONEY_STRIP_PATTERN,
)

MONEY = DecimalType(MONEY_PRECISION, MONEY_SCALE)
COORDINATE = DecimalType(COORDINATE_PRECISION, COORDINATE_SCALE)


def strip_money_text(c: Column) -> Column:
    """Trimmed text of ``c`` with everything but digits, '.' and '-' removed;
    '' becomes NULL. '$12,345.67' -> '12345.67'."""
    stripped = F.regexp_replace(F.trim(c.cast("string")), MONEY_STRIP_PATTERN, "")
    return F.nullif(stripped, F.lit(""))


def clean_money(c: Column, source_type: DataType | None = None,
                target: DecimalType = MONEY) -> Column:
    """Money as ``decimal(18,2)``; unparseable values become NULL.

    Text goes through :func:`strip_money_text`; a numeric source column is cast
    directly (its string form may be scientific, e.g. '1.0E7'). ``try_cast``
    keeps the result the same whether ANSI mode is on or off. Rounding is
    half-up: '1.005' -> 1.01. Known limits, kept on purpose: '($50.25)' loses
    its sign and '1.234,56' reads as 1.23.
    """
    if isinstance(source_type, NumericType):
        return c.try_cast(target)
    return strip_money_text(c).try_cast(target)


def to_decimal(c: Column, target: DecimalType) -> Column:
    """Plain fixed-point cast, NULL when the value does not fit or parse."""
    return c.try_cast(target)
