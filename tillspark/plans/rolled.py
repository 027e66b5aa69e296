"""Roll-ups kept beside the fact, and the reports that read them in its place.

Three of them, each additive: the rows made of two parts of the fact, taken together, stand for
the whole, so a load adds the rows of what the fact gained and reads nothing else. A report merges
the rows of its months and countries; its results equal those over the fact.

* invoices: the measures of an invoice per month and country.
* customers: the registered customers per month and country as bitmaps, which merge exactly.
* products: units, money and prices per day, country and product.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.constants import DOMESTIC_COUNTRY
from tillspark.functions.money import ratio, total
from tillspark.functions.sales import is_completed, sales_slice
from tillspark.plans import geography, kpis

MONTH = ["transaction_year", "transaction_month"]


def invoice_rollup(facts: DataFrame) -> DataFrame:
    """Measures per month, country and invoice."""
    return kpis.per_invoice(facts, *MONTH, "country")


def customer_rollup(facts: DataFrame) -> DataFrame:
    """Bitmaps of customer ids per month and country; a bitmap covers 32,768 neighbouring ids."""
    known = facts.where(F.col("customer_id").isNotNull())
    return known.groupBy(*MONTH, "country", F.bitmap_bucket_number("customer_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("customers")
    )


def product_rollup(facts: DataFrame) -> DataFrame:
    """Units, money and prices of completed lines per day, country and product."""
    return (
        facts.where(is_completed())
        .groupBy(*MONTH, F.to_date("invoice_date").alias("day"), "country", "stock_code", "description")
        .agg(
            F.sum("quantity").cast("bigint").alias("units"),
            F.sum("gross_amount").alias("amount"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("priced"),
        )
    )


def merged_customers(customers: DataFrame, *by: str) -> DataFrame:
    """One bitmap per group and range of ids."""
    return customers.groupBy(*by, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))


def distinct_customers(customers: DataFrame, *by: str) -> DataFrame:
    """Exact number of customers per group."""
    counted = merged_customers(customers, *by).select(*by, F.bitmap_count("customers").alias("n"))
    return counted.groupBy(*by).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("distinct_customers"))


def merged_products(products: DataFrame) -> DataFrame:
    """One row per day, country and product."""
    kept = {f.name: f.dataType for f in products.schema}
    return products.groupBy(*MONTH, "day", "country", "stock_code", "description").agg(
        *[F.sum(c).cast(kept[c]).alias(c) for c in ("units", "amount", "prices", "priced")]
    )


@dataclass(frozen=True)
class Rollups:
    """The three kept tables."""

    invoices: DataFrame
    customers: DataFrame
    products: DataFrame

    @classmethod
    def of(cls, facts: DataFrame) -> Rollups:
        return cls(invoice_rollup(facts), customer_rollup(facts), product_rollup(facts))

    def kpi_summary(self) -> DataFrame:
        return kpis.summary_of(kpis.merged_invoices(self.invoices))

    def sales_kpis(self, year: int | None = None, region: str | None = None, **options: str) -> DataFrame:
        keep = sales_slice(year, region, **options)
        customers = distinct_customers(self.customers.where(keep)).select("distinct_customers").scalar()
        return kpis.kpis_of(kpis.merged_invoices(self.invoices.where(keep)), customers)

    def sales_trends(self, year: int | None = None, region: str | None = None, **options: str) -> DataFrame:
        sliced = self.invoices.where(sales_slice(year, region, **options))
        return kpis.trends_of(kpis.merged_invoices(sliced, *MONTH))

    def geographic_sales(self) -> DataFrame:
        invoices = kpis.merged_invoices(self.invoices, "country")
        counted = geography.geography_of(invoices, distinct_customers(self.customers, "country"))
        return counted.withColumn("distinct_customers", F.coalesce("distinct_customers", F.lit(0)))

    def top_products(
        self, limit: int = 10, order_by: str = "revenue", region: str | None = None, domestic: str = DOMESTIC_COUNTRY
    ) -> DataFrame:
        ranking = "total_revenue" if order_by == "revenue" else "total_units"
        return (
            self.products.where(sales_slice(region=region, domestic=domestic))
            .groupBy("stock_code", "description")
            .agg(
                F.sum("units").cast("bigint").alias("total_units"),
                total(F.col("amount")).alias("total_revenue"),
                ratio(F.sum("prices"), F.sum("priced")).alias("avg_unit_price"),
            )
            .orderBy(F.col(ranking).desc(), "stock_code", "description")
            .limit(limit)
        )


@dataclass(frozen=True)
class Kept:
    """How a kept table is made of fact rows, and made smaller without a change of meaning."""

    made: Callable[[DataFrame], DataFrame]
    merged: Callable[[DataFrame], DataFrame]
    cluster: tuple[str, ...]


ROLLUPS = {
    "rollup_invoices": Kept(invoice_rollup, lambda s: kpis.merged_invoices(s, *MONTH, "country"), (*MONTH, "country")),
    "rollup_customers": Kept(customer_rollup, lambda s: merged_customers(s, *MONTH, "country"), (*MONTH, "country")),
    "rollup_products": Kept(product_rollup, merged_products, ("day",)),
}
