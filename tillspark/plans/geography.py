"""Country reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.money import percent, ratio, total
from tillspark.functions.sales import is_completed
from tillspark.operators.rollups import with_distinct_count
from tillspark.plans.kpis import count_sum, per_invoice


def geographic_sales(facts: DataFrame) -> DataFrame:
    """Orders, customers, units and money per country."""
    countries = _countries_of(per_invoice(facts, "country"))
    return _geography_of(with_distinct_count(countries, facts, "country", "customer_id", "distinct_customers"))


def geography_of(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """The same from one row per country and invoice, and the ``distinct_customers`` per country."""
    named = customers.withColumnRenamed("country", "_country")
    joined = _countries_of(invoices).join(named, F.col("country").eqNullSafe(F.col("_country")), "left")
    return _geography_of(joined.drop("_country"))


def _countries_of(invoices: DataFrame) -> DataFrame:
    return (
        invoices.groupBy("country")
        .agg(
            F.count("invoice_no").alias("total_orders"),
            count_sum("sold_units").alias("total_units"),
            total(F.col("sold_amount")).alias("gross_sales"),
            total(F.col("amount")).alias("net_sales"),
            F.count(F.when(F.col("has_sale") == 1, F.col("invoice_no"))).alias("_sold_orders"),
        )
    )


def _geography_of(countries: DataFrame) -> DataFrame:
    return (
        countries.withColumn("avg_order_value", ratio(F.col("gross_sales"), F.col("_sold_orders")))
        .drop("_sold_orders")
        .orderBy(F.col("gross_sales").desc(), "country")
    )


def country_share(facts: DataFrame, limit: int = 15) -> DataFrame:
    """Countries by revenue with their share of the grand total.

    The window for the total sees one row per country, after both aggregates. A scalar
    subquery would avoid it, but reads the fact a second time.
    """
    metrics = (
        per_invoice(facts.where(is_completed()), "country")
        .groupBy("country")
        .agg(
            F.count("*").alias("order_count"),
            count_sum("units").alias("units_sold"),
            total(F.col("amount")).alias("total_revenue"),
        )
    )
    grand_total = F.sum("total_revenue").over(Window.partitionBy())
    return (
        metrics.withColumn("revenue_pct", percent(F.col("total_revenue"), grand_total))
        .orderBy(F.col("total_revenue").desc(), "country")
        .limit(limit)
    )


def domestic_export_split(geography: DataFrame, domestic: str = K.DOMESTIC_COUNTRY) -> DataFrame:
    """Domestic against export revenue, market count and top export market: one row."""
    home = F.col("country") == domestic
    money = F.col("gross_sales")
    ranked = F.struct((-money).alias("rank"), "country", money.alias("sales"), "total_orders")
    best = F.min(F.when(~home, ranked))
    figures = geography.agg(
        total(F.when(home, money)).alias("domestic_sales"),
        total(F.when(~home, money)).alias("export_sales"),
        total(money).alias("_all"),
        F.count("*").alias("market_count"),
        best.alias("_best"),
    )
    share = F.coalesce(percent(F.col("domestic_sales"), F.col("_all")), F.lit(0).cast(K.RATIO))
    return figures.select(
        "domestic_sales",
        "export_sales",
        share.alias("domestic_pct"),
        (F.lit(100) - share).cast(K.RATIO).alias("export_pct"),
        "market_count",
        F.col("_best.country").alias("top_export_country"),
        F.col("_best.sales").alias("top_export_sales"),
        F.col("_best.total_orders").alias("top_export_orders"),
    )


def top_export_countries(
    geography: DataFrame, limit: int = 10, domestic: str = K.DOMESTIC_COUNTRY
) -> DataFrame:
    """Export markets by revenue."""
    return (
        geography.where(F.col("country") != domestic)
        .orderBy(F.col("gross_sales").desc(), "country")
        .limit(limit)
    )


def country_list(facts: DataFrame) -> DataFrame:
    """Distinct countries in order."""
    return facts.where(F.col("country").isNotNull()).select("country").distinct().orderBy("country")
