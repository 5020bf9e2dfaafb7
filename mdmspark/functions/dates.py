"""Flexible date parsing.

Each accepted layout is recognised by a whole-string regular expression,
then its fixed-width fields are cast as a calendar date. No date
formatter is involved, so the result does not depend on ANSI mode or on
``spark.sql.legacy.timeParserPolicy``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mdmspark.functions.constants import (
    ISO_DATE,
    MONTH_YEAR2,
    MONTH_YEAR4,
    SLASH_DATE,
    YEAR_MONTH,
)
from mdmspark.functions.text import is_blank


def parse_flexible_date(c: Column, end_of_month: bool = False) -> Column:
    """Date from text in one of several layouts; first match wins.

    On the space-trimmed text: NULL or '' -> NULL; ``MM/yyyy``, ``MM/yy`` and
    ``yyyy-MM`` -> first day of that month (two-digit years are 20yy); else
    the first of ``yyyy-MM-dd``, ``MM/dd/yyyy``, ``dd/MM/yyyy`` that gives a
    real date (so 03/04/2020 is 4 March, 25/12/2020 is 25 December); else
    NULL. With ``end_of_month`` every result is moved to the month's last day.

    The layouts have fixed-width digit fields, so after the shape check the
    fields are put in ISO order and cast, strictly (2020-02-30 is NULL) and with
    ANSI on or off; this is what a strict ``to_date`` with those formats accepts,
    without running a formatter per row. One cast for all layouts keeps the
    generated code short: the JVM does not compile methods of over 8,000 bytes.
    """
    v = F.trim(c.cast("string"))

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    def part(pos: int, length: int) -> Column:
        return F.substring(v, pos, length)

    n = F.length(v)

    def shape(length: int, pattern: str) -> Column:
        # the length test short-circuits, so at most two patterns run per row
        return (n == length) & v.rlike(pattern)

    first, second = part(1, 2), part(4, 2)
    iso = (
        F.when(shape(7, MONTH_YEAR4), text(part(4, 4), "-", first, "-01"))
        .when(shape(5, MONTH_YEAR2), text("20", second, "-", first, "-01"))
        .when(shape(7, YEAR_MONTH), text(v, "-01"))
        .when(shape(10, ISO_DATE), v)
        .when(shape(10, SLASH_DATE), text(part(7, 4), "-", first, "-", second))
    )
    # Day first, where month first was no date.
    swapped = F.when(shape(10, SLASH_DATE), text(part(7, 4), "-", second, "-", first))
    parsed = F.coalesce(iso.try_cast("date"), swapped.try_cast("date"))
    return F.last_day(parsed) if end_of_month else parsed


def is_present(c: Column) -> Column:
    """Raw value is neither NULL nor blank (spaces only)."""
    return ~is_blank(c)


def unparseable_date(c: Column) -> Column:
    """Present in the source but not a date in any accepted layout."""
    return is_present(c) & parse_flexible_date(c).isNull()
