"""Property tests: tolerant money and date parsing against a Python model."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.casts import to_day, to_money

digits = st.text(alphabet="0123456789", min_size=1, max_size=16)
money_text = st.one_of(
    st.builds(lambda s, i, f: f"{s}{i}.{f}" if f else f"{s}{i}",
              st.sampled_from(["", "-"]), digits,
              st.text(alphabet="0123456789", max_size=4)),
    st.text(alphabet="abc.-x ", min_size=1, max_size=6),
)


def money_model(text: str):
    """decimal(15,2): round half up to 2 places, NULL when > 13 integer digits
    or not a number."""
    try:
        if not text or not any(c.isdigit() for c in text) or text.strip() != text:
            return None
        v = Decimal(text)
    except Exception:  # noqa: BLE001
        return None
    q = v.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return None if abs(q) >= Decimal(10) ** 13 else q


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(money_text, min_size=1, max_size=40))
def test_money(spark, values):
    schema = StructType([StructField("t", StringType())])
    df = spark.createDataFrame([(v,) for v in values], schema)
    got = [r[0] for r in df.select(to_money(F.col("t"))).collect()]
    assert got == [money_model(v) for v in values]


dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


def render(d: dt.date, padded: bool, bad_month: bool) -> str:
    month = 13 if bad_month else d.month
    if padded:
        return f"{d.year:04d}-{month:02d}-{d.day:02d}"
    return f"{d.year}-{month}-{d.day}"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.tuples(dates, st.booleans(), st.booleans()), min_size=1, max_size=40))
def test_dates(spark, cases):
    texts = [render(*c) for c in cases]
    schema = StructType([StructField("t", StringType())])
    df = spark.createDataFrame([(t,) for t in texts], schema)
    got = [r[0] for r in df.select(to_day(F.col("t"), StringType())).collect()]
    want = []
    for (d, padded, bad), text in zip(cases, texts):
        ok = not bad and (padded or (d.month >= 10 and d.day >= 10))
        want.append(d if ok else None)
    assert got == want


# -- gold: production plan == literal formulation on random inputs -----------

from conftest import CUSTOMERS, DAILY, plain_sql
from strata.operators import gold  # noqa: E402
from strata.schemas import REVENUE  # noqa: E402
from pyspark.sql.types import DateType, IntegerType, LongType  # noqa: E402

ORDER_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderdate", DateType()), StructField("order_year", IntegerType()),
    StructField("order_month", IntegerType())])
LINE_SCHEMA = StructType([StructField("l_orderkey", LongType()),
                          StructField("revenue", REVENUE)])

order_rows = st.lists(st.tuples(st.integers(1, 8), st.one_of(st.none(), st.integers(1, 4)),
                                st.one_of(st.none(), st.dates(dt.date(1995, 1, 1),
                                                              dt.date(1995, 3, 31)))),
                      max_size=25)
line_rows = st.lists(st.tuples(st.integers(1, 9),
                               st.one_of(st.none(), st.decimals("0", "999.9999", places=4))),
                     max_size=40)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(order_rows, line_rows)
def test_gold_equals_plain_sql(spark, orders, lines):
    o = spark.createDataFrame(
        [(k, c, d, d.year if d else None, d.month if d else None) for k, c, d in orders],
        ORDER_SCHEMA)
    li = spark.createDataFrame(lines, LINE_SCHEMA)
    g = gold.build_gold(o, li)
    assert _same(g["revenue_by_order_date"], plain_sql(spark, DAILY, o, li))
    assert _same(g["top_customers"], plain_sql(spark, CUSTOMERS, o, li))
