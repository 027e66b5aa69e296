"""Product and customer dimensions derived from the sales fact.

Two definitions of each exist: the warehouse one counts returns, the lake one does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.constants import PRICE, SPEND
from tillspark.functions.money import ratio
from tillspark.functions.sales import is_completed


# Each warehouse dimension comes in two steps. The first makes states that may be kept and added
# to: the states of two parts of the fact, taken together, are states of the whole.


def product_states(facts: DataFrame) -> DataFrame:
    """Latest line, first sale and units per product."""
    latest = F.max(F.struct("invoice_date", "invoice_no", "unit_price", "description"))
    return facts.groupBy("stock_code").agg(
        latest.alias("latest"),
        F.min("invoice_date").alias("first_sold_at"),
        F.sum("quantity").cast("bigint").alias("units"),
    )


def merged_product_states(states: DataFrame) -> DataFrame:
    """One state per product."""
    return states.groupBy("stock_code").agg(
        F.max("latest").alias("latest"),
        F.min("first_sold_at").alias("first_sold_at"),
        F.sum("units").cast("bigint").alias("units"),
    )


def products_of(states: DataFrame) -> DataFrame:
    """The product dimension from states, any number per product."""
    return merged_product_states(states).select(
        "stock_code",
        F.col("latest.description").alias("description"),
        F.col("latest.unit_price").alias("latest_unit_price"),
        "first_sold_at",
        F.col("latest.invoice_date").alias("last_sold_at"),
        F.col("units").alias("total_units_sold"),
    )


def dim_products(facts: DataFrame) -> DataFrame:
    """Per product: latest description and price, first and last sale, units with returns."""
    return products_of(product_states(facts))


def customer_states(facts: DataFrame) -> DataFrame:
    """Spend and dates per invoice of a registered customer.

    Lines become invoices in a hash aggregate. Only that much smaller result goes through the
    text and struct extremes, which need sorting, and through the distinct count.
    """
    return (
        facts.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "invoice_no", "country")
        .agg(
            F.sum("gross_amount").alias("spend"),
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
        )
    )


def merged_customer_states(states: DataFrame) -> DataFrame:
    """One state per invoice, customer and country."""
    return states.groupBy("customer_id", "invoice_no", "country").agg(
        F.sum("spend").cast(states.schema["spend"].dataType).alias("spend"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def _customers_of(states: DataFrame, country: Column) -> DataFrame:
    return states.groupBy("customer_id").agg(
        country.alias("country"),
        F.countDistinct("invoice_no").alias("total_orders"),
        F.sum("spend").cast(SPEND).alias("total_spend"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
    )


def customers_of(states: DataFrame) -> DataFrame:
    """The customer dimension from states, any number per invoice."""
    return _customers_of(states, F.min(F.struct("first_date", "invoice_no", "country"))["country"])


def dim_customers(facts: DataFrame) -> DataFrame:
    """Per registered customer: first country, orders and spend, returns included."""
    return customers_of(customer_states(facts))


def dim_products_lake(facts: DataFrame) -> DataFrame:
    """Lake definition: units without returns, average price as the latest price.

    A hash aggregate per product and description comes first; only its small result is
    sorted for the largest description.
    """
    sold = F.when(is_completed(), F.col("quantity")).otherwise(0)
    named = facts.groupBy("stock_code", "description").agg(
        F.sum(sold).alias("units"),
        F.sum("unit_price").alias("prices"),
        F.count("unit_price").alias("priced"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
    )
    return named.groupBy("stock_code").agg(
        F.max("description").alias("description"),
        F.sum("units").cast("bigint").alias("total_units_sold"),
        ratio(F.sum("prices"), F.sum("priced")).cast(PRICE).alias("latest_unit_price"),
        F.min("first_date").alias("first_sold_at"),
        F.max("last_date").alias("last_sold_at"),
    )


def dim_customers_lake(facts: DataFrame) -> DataFrame:
    """Lake definition: completed lines only."""
    return _customers_of(customer_states(facts.where(is_completed())), F.max("country"))
