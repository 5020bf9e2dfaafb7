"""Code columns.

All are CASE chains of built-in expressions; NULL inputs follow SQL
three-valued logic (a NULL comparison never selects a branch).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mdmspark.functions.constants import (
    CHIP_FALSE,
    CHIP_TRUE,
    GENDER_FEMALE,
    GENDER_MALE,
    MCC_PAD,
    MCC_WIDTH,
    ONLINE,
    ONLINE_CHANNEL,
    ONLINE_CITY,
    PHYSICAL,
    PHYSICAL_CHANNELS,
    TRANSACTION_METHODS,
    UNKNOWN,
)


def _null_int() -> Column:
    return F.lit(None).cast("int")


def transaction_method(use_chip: Column) -> Column:
    """Exact, case-sensitive match of the channel text; anything else
    (NULL included) is UNKNOWN."""
    out = None
    for source, code in TRANSACTION_METHODS.items():
        cond = use_chip == F.lit(source)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out.otherwise(F.lit(UNKNOWN))


def location_type(use_chip: Column, city: Column) -> Column:
    """Where a sale took place, from channel and city:

    ==================  =========  =============  ===========
    channel             city text  'online' text  none, blank
    ==================  =========  =============  ===========
    online              ONLINE     ONLINE         ONLINE
    chip, swipe         PHYSICAL   ONLINE         UNKNOWN
    other, NULL         UNKNOWN    ONLINE         UNKNOWN
    ==================  =========  =============  ===========
    """
    place = F.upper(F.trim(F.coalesce(city, F.lit(""))))
    online = F.lit(ONLINE_CHANNEL).eqNullSafe(use_chip) | (place == ONLINE_CITY)
    in_person = use_chip.isin(*PHYSICAL_CHANNELS) & (place != "")
    return F.when(online, ONLINE).when(in_person, PHYSICAL).otherwise(UNKNOWN)


def gender_code(gender: Column) -> Column:
    """1 for male, 0 for female (any case or padding), else NULL."""
    g = F.upper(F.trim(gender))
    return (
        F.when(g == F.lit(GENDER_MALE), F.lit(1))
        .when(g == F.lit(GENDER_FEMALE), F.lit(0))
        .otherwise(_null_int())
    )


def chip_flag(has_chip: Column) -> Column:
    """1 / 0 from the accepted yes and no spellings, else NULL."""
    v = F.upper(F.trim(has_chip.cast("string")))
    return (
        F.when(v.isin(*CHIP_TRUE), F.lit(1))
        .when(v.isin(*CHIP_FALSE), F.lit(0))
        .otherwise(_null_int())
    )


def mcc_text(mcc: Column) -> Column:
    """Trimmed code text, NULL when NULL or blank."""
    return F.nullif(F.trim(mcc.cast("string")), F.lit(""))


def mcc_is_valid(mcc: Column) -> Column:
    """One to four digits after trimming. Checked on the raw text, so a longer
    code is rejected instead of being cut to four characters by the pad."""
    return F.coalesce(mcc_text(mcc).rlike(r"^\d{1,%d}$" % MCC_WIDTH), F.lit(False))


def normalize_mcc(mcc: Column) -> Column:
    """Four-digit code: '742' -> '0742'. NULL or blank -> NULL. A value that is
    not one to four digits is kept as its trimmed text (never cut), so it
    stays visible and fails :func:`mcc_is_valid`."""
    t = mcc_text(mcc)
    return F.when(mcc_is_valid(mcc), F.lpad(t, MCC_WIDTH, MCC_PAD)).otherwise(t)
