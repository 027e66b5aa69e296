from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions import money, parsing, sales, text


def value(spark, column, schema=None, *row):
    df = spark.createDataFrame([row], schema) if schema else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2011-02-03 04:05:06", datetime(2011, 2, 3, 4, 5, 6)),
        ("12/1/2010 8:26", datetime(2010, 12, 1, 8, 26)),
        ("01/02/2011 09:00", datetime(2011, 1, 2, 9, 0)),  # ambiguous: month first
        ("13/02/2011 09:00", datetime(2011, 2, 13, 9, 0)),  # only day first fits
        ("2011-02-03", datetime(2011, 2, 3)),
        ("2011-02-30", None),  # right shape, no such day
        ("2/30/2011 1:00", None),
        ("2011-02-03 04:05", None),  # none of the four formats
        ("2011-2-3", None),
        ("2011-02-03\n", None),
        (" 2011-02-03", None),
        ("2011-02-03 24:00:00", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, raw, expected):
    assert value(spark, parsing.parse_timestamp(F.col("t")).cast("timestamp_ntz"), "t string", raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("17850.0", 17850), ("17850", 17850), (" 7 ", 7), ("", None), (" ", None), (None, None), ("abc", None)],
)
def test_nullable_id(spark, raw, expected):
    assert value(spark, parsing.nullable_id(F.col("t")), "t string", raw) == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("2024/01/02", date(2024, 1, 2)), ("2024-01-02", date(2024, 1, 2)), ("junk", None), (None, None)],
)
def test_parse_order_date(spark, raw, expected):
    assert value(spark, parsing.parse_order_date(F.col("t")), "t string", raw) == expected


@pytest.mark.parametrize(
    "raw",
    ["2011-02-03 04:05:06", "2/3/2011 4:05", "02/03/2011 04:05", "23/03/2011 04:05", "2011-02-03",
     "12/31/2011 23:59", "1/1/2011 0:00", "0012/1/2011 1:00", "2011-13-01", "31/04/2011 10:00",
     "+12011-01-01", "99/99/2011 10:00", "2011-02-03T04:05:06", "2011-02-03 4:05:06"],
)
def test_guards_change_no_result(spark, raw):
    plain = F.coalesce(*[F.try_to_timestamp(F.col("t"), F.lit(f)) for f in K.INVOICE_DATE_FORMATS])
    df = spark.createDataFrame([(raw,)], "t string")
    row = df.select(plain.alias("a"), parsing.parse_timestamp(F.col("t")).alias("b")).select(
        F.col("a").eqNullSafe(F.col("b")).alias("same"), F.col("a").cast("string"), F.col("b").cast("string")
    ).first()
    assert row.same, row


def test_decimal_default_stays_decimal(spark):
    df = spark.createDataFrame([("x",), ("2.5",)], "t string")
    out = df.select(parsing.decimal_or(F.col("t"), "decimal(5,2)", "0.00").alias("v"))
    assert out.schema["v"].dataType.simpleString() == "decimal(5,2)"
    assert [r.v for r in out.collect()] == [Decimal("0.00"), Decimal("2.50")]


def test_nan_becomes_null_only_in_float_columns(spark):
    df = spark.createDataFrame([(float("nan"), "NaN"), (1.5, "x")], "a double, b string")
    assert [tuple(r) for r in parsing.nan_to_null(df).collect()] == [(None, "NaN"), (1.5, "x")]


@pytest.mark.parametrize(
    "invoice, quantity, flag",
    [("536365", 6, 0), ("C1", 6, 1), ("1", -1, 1), ("c1", 1, 0), ("1", None, 0), (None, -1, 1), ("C1", None, 1)],
)
def test_cancellation_flag(spark, invoice, quantity, flag):
    expr = sales.cancellation_flag(F.col("i"), F.col("q"))
    assert value(spark, expr, "i string, q int", invoice, quantity) == flag


def test_line_amount_overflow_is_null(spark):
    expr = money.line_amount(F.col("q"), F.col("p"))
    schema = "q int, p decimal(10,2)"
    assert value(spark, expr, schema, 6, Decimal("2.55")) == Decimal("15.30")
    assert value(spark, expr, schema, 2_000_000_000, Decimal("99999999.99")) is None


def test_discount_rounds_half_up(spark):
    expr = money.discount_amount(F.col("g"), F.col("d"))
    assert value(spark, expr, "g decimal(12,2), d decimal(5,2)", Decimal("0.50"), Decimal("1.00")) == Decimal("0.01")


def test_ratio_is_exact_and_safe(spark):
    expr = money.ratio(F.col("a"), F.col("b"))
    assert value(spark, expr, "a decimal(12,2), b int", Decimal("2.01"), 2) == Decimal("1.01")
    assert value(spark, expr, "a decimal(12,2), b int", Decimal("2.01"), 0) is None


@pytest.mark.parametrize(
    "price, label",
    [
        ("1.99", "Budget (< £2.00)"),
        ("2.00", "Standard (£2.00 - £5.00)"),
        ("5.00", "Standard (£2.00 - £5.00)"),
        ("5.005", "Luxury / Bulk (> £15.00)"),  # falls into the gap between the closed ranges
        ("5.01", "Premium (£5.01 - £15.00)"),
        ("15.01", "Luxury / Bulk (> £15.00)"),
        (None, "Luxury / Bulk (> £15.00)"),
    ],
)
def test_price_bands(spark, price, label):
    expr = sales.band_label(F.col("p"), K.PRICE_BANDS, K.PRICE_BAND_REST)
    assert value(spark, expr, "p decimal(10,3)", price and Decimal(price)) == label


@pytest.mark.parametrize(
    "spend, label",
    [
        ("10000", "VIP Tier (>£10k)"),
        ("9999.99", "High-Value (£2k-£10k)"),
        ("500", "Mid-Tier (£500-£2k)"),
        ("499.99", "Budget (<£500)"),
        (None, "Budget (<£500)"),
    ],
)
def test_spend_bands(spark, spend, label):
    expr = sales.band_label(F.col("p"), K.SPEND_BANDS, K.SPEND_BAND_REST)
    assert value(spark, expr, "p decimal(14,2)", spend and Decimal(spend)) == label


def test_slices(spark):
    df = spark.createDataFrame(
        [(2010, "United Kingdom"), (2011, "United Kingdom"), (2011, "France")],
        "transaction_year int, country string",
    )

    def rows(*args):
        return df.where(sales.sales_slice(*args)).count()

    assert rows() == 3 and rows(None, "Global") == 3
    assert rows(2011) == 2
    assert rows(None, "UK") == 2 and rows(None, "International") == 1
    assert rows(2011, "UK") == 1 and rows(None, "France") == 1


def test_period_label(spark):
    assert value(spark, sales.period_label(F.lit(2011), F.lit(3))) == "2011-03"


def test_text_helpers(spark):
    assert value(spark, text.blank_to(F.lit("  "), "x")) == "x"
    assert value(spark, text.blank_to(F.lit(None).cast("string"), "x")) == "x"
    assert value(spark, text.blank_to(F.lit(" a "), "x")) == "a"
    assert value(spark, text.title_words(F.lit("north   WEST\tzone"))) == "North West Zone"
    assert value(spark, text.is_blank(F.lit(" \t\n"))) is True
    df = spark.createDataFrame([(" a ", 1)], ["Order ID", "unit-price "])
    assert text.normalise_headers(df).columns == ["order_id", "unit_price"]
    assert text.trim_text_columns(df).first()[0] == "a"


def test_search_term_wildcards_and_case(spark):
    df = spark.createDataFrame([("RED ring", 17), ("blue", 2)], "d string, c int")
    assert df.where(text.any_contains(["d"], "red")).count() == 1
    assert df.where(text.any_contains(["d"], "red", case_sensitive=True)).count() == 0
    assert df.where(text.any_contains(["d", "c"], "1")).count() == 1
    assert df.where(text.any_contains(["d"], "r_d")).count() == 1
