from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.functions import (
    cleaned,
    date_key,
    discount_amount,
    gross_amount,
    month_name,
    net_amount,
    surrogate_key,
    weekday_name,
)

CENT = Decimal("0.01")
lines = st.tuples(
    st.integers(-1000, 100_000),
    st.decimals(0, Decimal("99999.99"), places=2),
    st.none() | st.decimals(0, 100, places=2),
)


def cents(value):
    return value.quantize(CENT, ROUND_HALF_UP)


@settings(max_examples=5, deadline=None)
@given(st.lists(lines, min_size=20, max_size=60))
def test_amounts_are_exact(spark, rows):
    schema = "q int, p decimal(12,2), d decimal(5,2)"
    q, p, d = F.col("q"), F.col("p"), F.col("d")
    df = spark.createDataFrame(rows, schema).select(
        "q",
        "p",
        "d",
        gross_amount(q, p).alias("gross"),
        discount_amount(q, p, d).alias("discount"),
        net_amount(q, p, d).alias("net"),
    )
    assert {t for _, t in df.dtypes[3:]} == {"decimal(18,2)"}
    for r in df.collect():
        share = (r.d or Decimal(0)) / 100
        assert r.gross == cents(r.q * r.p)
        assert r.discount == cents(r.q * r.p * share)
        assert r.net == cents(r.q * r.p * (1 - share))


def test_parts_need_not_add_up(spark):
    df = spark.createDataFrame(
        [(1, Decimal("0.99"), Decimal("50.00"))], "q int, p decimal(12,2), d decimal(5,2)"
    )
    q, p, d = F.col("q"), F.col("p"), F.col("d")
    row = df.select(gross_amount(q, p), discount_amount(q, p, d), net_amount(q, p, d)).first()
    assert tuple(row) == (Decimal("0.99"), Decimal("0.50"), Decimal("0.50"))


def test_surrogate_keys(spark):
    keys = [1, -7, 2**40, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in df.select(surrogate_key("customer", F.col("k"))).collect()]
    texts = ["customer|" + ("" if k is None else str(k)) for k in keys]
    assert got == [sha256(t.encode()).hexdigest().upper() for t in texts]


def test_text_is_trimmed_of_blanks_only(spark):
    df = spark.createDataFrame([("  A\tb \t ", "  Åß X ", None)], "a string, b string, c string")
    row = df.select(cleaned("a", "trim"), cleaned("b", "lower"), cleaned("c", "upper")).first()
    assert tuple(row) == ("A\tb \t", "åß x", None)
    assert df.select(cleaned("b", None)).first()[0] == "  Åß X "


def test_calendar(spark):
    day = F.col("d")
    df = spark.createDataFrame([(date(2026, 8, 21),), (date(1999, 12, 31),)], "d date")
    result = df.select(date_key(day).alias("k"), month_name(day), weekday_name(day))
    assert result.dtypes[0] == ("k", "int")
    assert [tuple(r) for r in result.collect()] == [
        (20260821, "August", "Friday"),
        (19991231, "December", "Friday"),
    ]
