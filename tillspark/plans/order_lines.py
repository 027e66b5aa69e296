"""The order-line path: clean raw order text, enrich, add financials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.parsing import decimal_or, parse_order_date, whole_number
from tillspark.functions.text import blank_to, normalise_headers, title_words, trim_text_columns
from tillspark.operators.dedup import first_per_key
from tillspark.operators.joins import enrich_order_lines
from tillspark.operators.rollups import with_financials


def typed_order_lines(raw: DataFrame) -> DataFrame:
    """Normalised headers, trimmed text, parsed dates, defaults and typed numbers."""
    df = trim_text_columns(normalise_headers(raw))
    cleaned = {
        "order_date": parse_order_date(F.col("order_date")),
        "payment_method": blank_to(F.col("payment_method"), K.UNKNOWN_PAYMENT),
        "order_status": F.initcap(blank_to(F.col("order_status"), K.DEFAULT_ORDER_STATUS)),
        "region": title_words(blank_to(F.col("region"), K.UNKNOWN_REGION)),
        "quantity": whole_number(F.col("quantity")),
        "unit_price": decimal_or(F.col("unit_price"), K.PRICE),
        "discount": decimal_or(F.col("discount"), "decimal(5,2)", "0.00"),
    }
    return df.select(*[cleaned.get(c, F.col(c)).alias(c) for c in df.columns])


def clean_order_lines(raw: DataFrame) -> DataFrame:
    """Typed order lines, one per (order, product)."""
    return first_per_key(typed_order_lines(raw), K.ORDER_LINE_KEY)


def priced_order_lines(raw: DataFrame, catalog: DataFrame, customers: DataFrame) -> DataFrame:
    """Clean, enrich and price raw order lines in one plan."""
    return with_financials(enrich_order_lines(clean_order_lines(raw), catalog, customers))
