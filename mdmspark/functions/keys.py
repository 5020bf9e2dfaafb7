"""Hashed surrogate keys.

The key is computed from the raw (untrimmed) parts, each cast to text with
NULL read as '', joined by '||', hashed with ``xxhash64`` and reduced into
[0, 2^63 - 1) with ``pmod``. Fact and dimension must use this one function so
their keys agree. Known properties, kept on purpose: NULL and '' give the same
key; '||' inside a part can alias two tuples; ' Paris' and 'Paris' are
different merchants. The 63-bit space makes a collision unlikely but not
impossible (about n^2 / 2^64 expected pairs), so the merchant quality rules
count keys that carry more than one natural key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mdmspark.functions.constants import KEY_MODULUS, KEY_SEPARATOR


def natural_key_text(*parts: Column) -> Column:
    """The text that is hashed: parts as text, NULL -> '', joined by '||'."""
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def surrogate_key(*parts: Column) -> Column:
    """Non-negative 63-bit key of the parts; never NULL."""
    return F.pmod(F.xxhash64(natural_key_text(*parts)), F.lit(KEY_MODULUS)).cast("long")


def merchant_key(merchant_id: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Merchant surrogate key from the raw transaction columns."""
    return surrogate_key(merchant_id, city, state, zip_code)
