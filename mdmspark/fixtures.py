"""Dirty source tables derived from the benchmark tables.

The reference ships no data; these SQL texts turn ``customer``, ``orders``,
``part`` and ``lineitem`` into users, cards, MCC codes and transactions with
the dirt the pipelines must handle (padding, mixed case, money text, mixed
date layouts, bad codes, duplicate ids, NULLs). Each text runs unchanged in
Spark SQL and in DuckDB over views of the same names, so a query and its
oracle start from identical rows. Row counts follow the base tables, so the
work grows with the scale factor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
USERS_SRC = """
select case when c_custkey % 20 = 19 then c_custkey - 1 else c_custkey end as id,
  c_custkey % 80 as current_age,
  1940 + c_custkey % 60 as birth_year,
  cast(c_custkey % 12 + 1 as string) as birth_month,
  case c_custkey % 5 when 0 then ' male ' when 1 then 'FEMALE' when 2 then 'Female' when 3 then '' else null end as gender,
  concat('  ', c_name, ' ') as address,
  concat(cast(c_custkey % 90 as string), '.', lpad(cast(c_custkey % 1000000 as string), 6, '0')) as latitude,
  concat('-', cast(c_custkey % 180 as string), '.', lpad(cast(c_custkey * 7 % 1000000 as string), 6, '0')) as longitude,
  cast(cast(c_acctbal as decimal(18,2)) as string) as per_capita_income,
  case when c_custkey % 7 = 0 then ''
       when c_custkey % 11 = 0 then 'N/A'
       when c_custkey % 13 = 0 then '12-34'
       when c_custkey % 3 = 0 then concat('$', cast(c_custkey as string), ',345.67')
       else concat('$', cast(cast(c_acctbal as decimal(18,2)) as string)) end as yearly_income,
  case when c_custkey % 4 = 0 then null
       else concat('$', cast(c_nationkey * 1000 + c_custkey % 100 as string), '.50') end as total_debt,
  case when c_custkey % 9 = 0 then '12.7' else cast(600 + c_custkey % 250 as string) end as credit_score,
  c_nationkey % 6 as num_credit_cards
from customer
"""

CARDS_SRC = """
select case when o_orderkey % 15 = 14 then o_orderkey - 1 else o_orderkey end as id,
  case when o_orderkey % 50 = 0 then null else o_custkey end as client_id,
  case o_orderstatus when 'F' then ' debit ' when 'O' then 'Credit' else 'Debit (Prepaid)' end as card_type,
  case o_orderkey % 4 when 0 then 'Visa' when 1 then ' mastercard' when 2 then 'Amex ' else null end as card_brand,
  concat(' 4', lpad(cast(o_orderkey as string), 15, '0'), ' ') as card_number,
  case o_orderkey % 9
    when 0 then concat(substr(d, 6, 2), '/', substr(d, 1, 4))
    when 1 then concat(substr(d, 6, 2), '/', substr(d, 3, 2))
    when 2 then substr(d, 1, 7)
    when 3 then d
    when 4 then concat(' ', substr(d, 6, 2), '/', substr(d, 9, 2), '/', substr(d, 1, 4), ' ')
    when 5 then concat(substr(d, 9, 2), '/', substr(d, 6, 2), '/', substr(d, 1, 4))
    when 6 then ''
    when 7 then '13/2025'
    else null end as expires,
  lpad(cast(o_orderkey % 1000 as string), 3, '0') as cvv,
  case o_orderkey % 10 when 0 then 'YES' when 1 then ' y' when 2 then 'True' when 3 then '1' when 4 then 'no'
    when 5 then 'N' when 6 then 'FALSE' when 7 then '0' when 8 then 'maybe' else null end as has_chip,
  cast(o_orderkey % 3 + 1 as string) as num_cards_issued,
  concat('$', cast(cast(o_totalprice as decimal(18,2)) as string)) as credit_limit,
  case o_orderkey % 7
    when 0 then d
    when 1 then concat(substr(d, 6, 2), '/', substr(d, 9, 2), '/', substr(d, 1, 4))
    when 2 then substr(d, 1, 7)
    when 3 then concat(substr(d, 6, 2), '/', substr(d, 1, 4))
    when 4 then 'garbage'
    when 5 then '2020-02-30'
    else null end as acct_open_date,
  cast(2000 + o_orderkey % 25 as string) as year_pin_last_changed
from (select *, cast(cast(o_orderdate as date) as string) as d from orders) o
"""

MCC_SRC = """
select case when p_partkey % 13 = 0 then null when p_partkey % 17 = 0 then ' '
            when p_partkey % 19 = 0 then '12345' when p_partkey % 23 = 0 then 'ab'
            else cast(p_partkey % 1100 as string) end as mcc_id,
  case when p_partkey % 29 = 0 then null when p_partkey % 37 = 0 then concat(' ', repeat(concat(p_type, ' sold in many places, '), 60))
    else concat(' ', p_type, ' ') end as description
from part
"""

# Valid codes that still conflict, and one description for each valid code.
MCC_VALID_SRC = """
select cast(p_partkey % 1100 as string) as mcc_id, case when p_partkey % 29 = 0 then null else concat(' ', p_type, ' ') end as description
from part
"""

MCC_CLEAN_SRC = """
select cast(p_partkey % 10000 as string) as mcc_id, min(concat(' ', p_name, ' ', p_type)) as description
from part group by p_partkey % 10000
"""

# The same users and cards, some without an id.
USERS_DIRTY_SRC = f"""
select case when current_age = 7 then null else id end as id, current_age, birth_year, birth_month, gender, address, latitude, longitude,
  per_capita_income, yearly_income, total_debt, credit_score, num_credit_cards
from ({USERS_SRC}) u
"""

# Text that needs care in CSV files.
CSV_TEXT_SRC = """
select p_partkey as id,
  case p_partkey % 10
    when 0 then concat('two', chr(10), 'lines of ', p_name) when 1 then concat(chr(13), chr(10), p_name) when 2 then concat('"', p_name, '", "quoted"')
    when 3 then concat('back', chr(92), 'slash ', p_name, chr(92)) when 4 then '' when 5 then null when 6 then concat('  ', p_name, '  ')
    when 7 then concat(chr(34), chr(10), chr(34)) when 8 then 'a,b;c|d' else p_name end as note,
  case when p_partkey % 3 = 0 then null else p_type end as kind
from part
"""

TRANSACTIONS_SRC = """
select l_orderkey as id, l_shipdate as date, l_partkey as client_id, 
  case when l_orderkey % 15 = 14 then l_orderkey - 1 else l_orderkey end as card_id,
  concat('$', cast(cast(l_extendedprice as decimal(18,2)) as string)) as amount,
  case l_returnflag when 'A' then 'Chip Transaction' when 'N' then 'Online Transaction'
    else case when l_linenumber = 7 then null else 'Swipe Transaction' end end as use_chip,
  l_suppkey as merchant_id,
  case l_linenumber when 1 then 'ONLINE' when 2 then ' Paris' when 3 then 'Paris' when 4 then null when 5 then ''
    else concat('City', cast(l_suppkey % 7 as string)) end as merchant_city,
  case when l_linenumber > 5 then ' ny ' else null end as merchant_state,
  case when l_suppkey % 2 = 0 then '10001' else null end as zip,
  l_partkey % 1000 as mcc,
  case when l_discount >= 0.09 then 'Insufficient Balance' else null end as errors
from lineitem
"""

CARDS_DIRTY_SRC = f"""
select case when num_cards_issued = '2' and cvv like '%7' then null else id end as id, client_id, card_type, card_brand, card_number, expires, cvv,
  has_chip, num_cards_issued, credit_limit, acct_open_date, year_pin_last_changed
from ({CARDS_SRC}) c
"""

# Ids that crowd at small values, with far outliers and NULLs.
SKEWED_IDS_SRC = """
select case when o_orderkey % 97 = 0 then null when o_orderkey % 1009 = 0 then o_orderkey * 100000000007
            when o_orderkey % 3 = 0 then o_orderkey else o_orderkey * o_orderkey end as id, o_custkey as client_id
from orders
"""

FIXTURES = {
    "users_src": (USERS_SRC, ("customer",)),
    "cards_src": (CARDS_SRC, ("orders",)),
    "mcc_src": (MCC_SRC, ("part",)),
    "transactions_src": (TRANSACTIONS_SRC, ("lineitem",)),
    "users_dirty_src": (USERS_DIRTY_SRC, ("customer",)),
    "cards_dirty_src": (CARDS_DIRTY_SRC, ("orders",)),
    "mcc_valid_src": (MCC_VALID_SRC, ("part",)),
    "mcc_clean_src": (MCC_CLEAN_SRC, ("part",)),
    "skewed_ids_src": (SKEWED_IDS_SRC, ("orders",)),
    "csv_text_src": (CSV_TEXT_SRC, ("part",)),
}


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The dirty source ``name`` over the tables in ``sf_dir``. The base
    tables are bound as DataFrame parameters of ``spark.sql``, so no view
    name is registered in (or taken from) the caller's session."""
    sql, tables = FIXTURES[name]
    pattern = r"\b(from|join)\s+(" + "|".join(tables) + r")\b"
    text = re.sub(pattern, lambda m: f"{m.group(1)} {{{m.group(2)}}}", sql, flags=re.IGNORECASE)
    return spark.sql(text, **{t: base_table(spark, sf_dir, t) for t in tables})


def with_fixtures(body: str, *names: str) -> str:
    """``body`` prefixed by a WITH clause defining the named fixtures (for the
    DuckDB oracle, where the base tables are views)."""
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n][0]})" for n in names)
    return f"WITH {ctes}\n{body}"
