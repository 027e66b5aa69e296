"""Product rankings, price bands and catalog search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.money import mean, ratio, total
from tillspark.functions.sales import band_label, is_cancelled, is_completed, sales_slice
from tillspark.functions.text import any_contains


def top_products(
    facts: DataFrame,
    limit: int = 10,
    order_by: str = "revenue",
    region: str | None = None,
    **options: str,
) -> DataFrame:
    """Best-selling products by revenue, or by units for any other ``order_by``."""
    ranking = "total_revenue" if order_by == "revenue" else "total_units"
    return (
        facts.where(is_completed() & sales_slice(region=region, **options))
        .groupBy("stock_code", "description")
        .agg(
            F.sum("quantity").cast("bigint").alias("total_units"),
            total(F.col("gross_amount")).alias("total_revenue"),
            mean(F.col("unit_price")).alias("avg_unit_price"),
        )
        .orderBy(F.col(ranking).desc(), "stock_code", "description")
        .limit(limit)
    )


def top_products_ranked(facts: DataFrame, limit: int = 10) -> DataFrame:
    """Top products by revenue with their dense rank.

    Any product above another in the ranking is in the shortlist too, so ranking the
    shortlist gives the global rank without gathering all products in one task.
    """
    shortlist = (
        facts.where(is_completed() & (F.col("unit_price") > 0))
        .groupBy("stock_code", "description")
        .agg(
            F.sum("quantity").cast("bigint").alias("units_sold"),
            total(F.col("gross_amount")).alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), "stock_code", "description")
        .limit(limit)
    )
    return shortlist.select(
        "stock_code",
        F.coalesce("description", F.lit("UNKNOWN")).alias("description"),
        "units_sold",
        "total_revenue",
        F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc())).alias("revenue_rank"),
    )


def top_returned_products(facts: DataFrame, limit: int = 10) -> DataFrame:
    """Products with the most returned units."""
    return (
        facts.where(is_cancelled())
        .groupBy("stock_code", "description")
        .agg(
            F.sum(F.abs("quantity")).cast("bigint").alias("total_returned_units"),
            total(F.abs("gross_amount")).alias("total_returned_value"),
        )
        .orderBy(F.col("total_returned_units").desc(), "stock_code", "description")
        .limit(limit)
        .withColumn("description", F.coalesce("description", F.lit("UNKNOWN")))
    )


def price_tiers(
    facts: DataFrame,
    bands: Sequence[K.Band] = K.PRICE_BANDS,
    rest: str = K.PRICE_BAND_REST,
) -> DataFrame:
    """Completed lines, units and revenue per price band."""
    return (
        facts.where(is_completed())
        .groupBy(band_label(F.col("unit_price"), bands, rest).alias("price_tier"))
        .agg(
            F.count("*").alias("transaction_lines"),
            F.sum("quantity").cast("bigint").alias("units_sold"),
            total(F.col("gross_amount")).alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc())
    )


def product_search(
    products: DataFrame, term: str, limit: int = 25, case_sensitive: bool = False
) -> DataFrame:
    """Products whose code or description contains ``term``, most sold first."""
    found = products.where(any_contains(["stock_code", "description"], term, case_sensitive))
    return (
        found.orderBy(F.col("total_units_sold").desc(), "stock_code")
        .limit(limit)
        .select(
            "stock_code",
            "description",
            F.col("total_units_sold").alias("total_units"),
            F.col("latest_unit_price").alias("unit_price"),
            ratio(F.col("total_units_sold") * F.col("latest_unit_price"), F.lit(1)).alias(
                "estimated_revenue"
            ),
            F.col("first_sold_at").alias("first_sale"),
            F.col("last_sold_at").alias("latest_sale"),
        )
    )
