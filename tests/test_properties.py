"""Property tests: the flexible date parser against a plain-Python reading of
the same layouts, and dedup against a Python minimum."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mdmspark.functions import parse_flexible_date
from mdmspark.operators import dedup


def _ymd(y, m, d):
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


def py_parse(text):
    if text is None:
        return None
    v = text.strip(" ")
    n = len(v)
    digits = lambda s: s.isascii() and s.isdigit()
    if n == 7 and v[2] == "/" and digits(v[:2] + v[3:]):
        return _ymd(int(v[3:]), int(v[:2]), 1)
    if n == 5 and v[2] == "/" and digits(v[:2] + v[3:]):
        return _ymd(2000 + int(v[3:]), int(v[:2]), 1)
    if n == 7 and v[4] == "-" and digits(v[:4] + v[5:]):
        return _ymd(int(v[:4]), int(v[5:]), 1)
    if n == 10 and v[4] == "-" and v[7] == "-" and digits(v[:4] + v[5:7] + v[8:]):
        return _ymd(int(v[:4]), int(v[5:7]), int(v[8:]))
    if n == 10 and v[2] == "/" and v[5] == "/" and digits(v[:2] + v[3:5] + v[6:]):
        a, b, y = int(v[:2]), int(v[3:5]), int(v[6:])
        return _ymd(y, a, b) or _ymd(y, b, a)
    return None


two = st.integers(0, 39).map(lambda i: f"{i:02d}")
four = st.integers(1, 9999).map(lambda i: f"{i:04d}")
pad = st.sampled_from(["", " ", "  "])
shaped = st.one_of(
    st.builds(lambda m, y: f"{m}/{y}", two, four),
    st.builds(lambda m, y: f"{m}/{y}", two, two),
    st.builds(lambda y, m: f"{y}-{m}", four, two),
    st.builds(lambda y, m, d: f"{y}-{m}-{d}", four, two, two),
    st.builds(lambda a, b, y: f"{a}/{b}/{y}", two, two, four),
)
texts = st.one_of(
    st.builds(lambda p, s, q: p + s + q, pad, shaped, pad),
    st.text(alphabet="0123456789/- ab\t", max_size=11),
    st.none(),
)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=60))
def test_flexible_date_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(parse_flexible_date(F.col("v"))).collect()]
    assert got == [py_parse(v) for v in values]


def test_year_zero_is_a_date(spark):
    df = spark.createDataFrame([("0000-01-01",)], "v string")
    assert df.select(parse_flexible_date(F.col("v")).cast("string")).first()[0] == "0000-01-01"


rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
              st.one_of(st.none(), st.integers(-3, 3))),
    min_size=1, max_size=40,
)


def _key(v):
    # NULLS FIRST, then value
    return (v is not None, v if v is not None else 0)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_dedup_keeps_python_minimum(spark, data):
    df = spark.createDataFrame(data, "k int, s string, n int")
    got = sorted(map(tuple, dedup(df, "k").collect()), key=repr)
    best = {}
    for k, s, n in data:
        cand = (s, n)
        if k not in best or (_key(cand[0]), _key(cand[1])) < (_key(best[k][0]), _key(best[k][1])):
            best[k] = cand
    assert got == sorted([(k, s, n) for k, (s, n) in best.items()], key=repr)
