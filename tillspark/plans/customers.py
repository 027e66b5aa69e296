"""Customer value bands and rankings over the customer dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.money import ratio, total
from tillspark.functions.sales import band_label


def customer_tiers(
    customers: DataFrame,
    bands: Sequence[K.Band] = K.SPEND_BANDS,
    rest: str = K.SPEND_BAND_REST,
) -> DataFrame:
    """Customers, revenue and mean orders per lifetime spend band."""
    return (
        customers.groupBy(band_label(F.col("total_spend"), bands, rest).alias("spend_tier"))
        .agg(
            F.count("*").alias("customer_count"),
            total(F.col("total_spend")).alias("tier_revenue"),
            ratio(F.sum("total_orders"), F.count("total_orders"), 1).alias("avg_orders_per_customer"),
        )
        .orderBy(F.col("tier_revenue").desc())
    )


def _by_spend(customers: DataFrame, limit: int) -> DataFrame:
    return customers.orderBy(F.col("total_spend").desc(), "customer_id").limit(limit)


def top_customers(customers: DataFrame, limit: int = 10) -> DataFrame:
    """Customers with the highest lifetime spend."""
    return _by_spend(customers, limit).select(
        "customer_id",
        "country",
        "total_orders",
        F.col("total_spend").alias("lifetime_spend"),
        "first_order_date",
        "last_order_date",
    )


def top_vips(customers: DataFrame, limit: int = 10) -> DataFrame:
    """Customers with the highest lifetime spend and their average order value."""
    return _by_spend(customers, limit).select(
        "customer_id",
        "country",
        "total_orders",
        "total_spend",
        ratio(F.col("total_spend"), F.col("total_orders")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
    )
