"""Whole-business figures and time series over the sales fact.

Reports that count invoices first reduce the fact to invoices. That first step combines
on the map side, turns every later distinct invoice count into a plain count, and keeps a
dominant country, month or customer from gathering raw lines in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspark.constants import TOTAL
from tillspark.functions.money import percent, ratio, total
from tillspark.functions.sales import (
    checkout_type,
    is_cancelled,
    is_completed,
    is_guest,
    period_label,
    sales_slice,
)
from tillspark.operators.rollups import distinct_count


INVOICE_MEASURES = [
    "lines", "units", "amount", "sold_units", "sold_amount", "returned_units", "cancelled_amount",
    "returned_amount", "cancelled_lines", "guest_lines", "guest_amount", "has_sale", "has_return",
]


def per_invoice(facts: DataFrame, *by: str) -> DataFrame:
    """One row per ``by`` and invoice with every measure the reports sum up.

    Measures a report does not use are pruned by the optimiser, and with them their columns.
    """

    def when(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))

    units, amount = F.col("quantity"), F.col("gross_amount")
    return facts.groupBy(*by, "invoice_no").agg(
        F.count("*").alias("lines"),
        F.sum(units).alias("units"),
        F.sum(amount).alias("amount"),
        when(is_completed(), units).alias("sold_units"),
        when(is_completed(), amount).alias("sold_amount"),
        when(is_cancelled(), F.abs(units)).alias("returned_units"),
        when(is_cancelled(), amount).alias("cancelled_amount"),
        when(is_cancelled(), F.abs(amount)).alias("returned_amount"),
        F.count_if(is_cancelled()).alias("cancelled_lines"),
        F.count_if(is_guest() & is_completed()).alias("guest_lines"),
        when(is_guest() & is_completed(), amount).alias("guest_amount"),
        F.max(F.when(is_completed(), 1).otherwise(0)).alias("has_sale"),
        F.max(F.when(is_cancelled(), 1).otherwise(0)).alias("has_return"),
    )


def merged_invoices(states: DataFrame, *by: str) -> DataFrame:
    """Kept invoice measures, any number of rows per invoice, as ``per_invoice`` returns them."""
    flags = ["has_sale", "has_return"]
    measures = [f.name for f in states.schema if f.name in INVOICE_MEASURES]
    types = {f.name: f.dataType for f in states.schema}
    return states.groupBy(*by, "invoice_no").agg(
        *[(F.max(m) if m in flags else F.sum(m).cast(types[m])).alias(m) for m in measures]
    )


def count_sum(name: str) -> Column:
    """Sum of a counter; zero over no rows."""
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def kpi_summary(facts: DataFrame) -> DataFrame:
    """Overall revenue, units and returns: one row."""
    return summary_of(per_invoice(facts))


def summary_of(invoices: DataFrame) -> DataFrame:
    """The KPI summary from one row per invoice."""
    return invoices.agg(
        F.count("*").alias("total_invoices"),
        count_sum("lines").alias("total_line_items"),
        count_sum("sold_units").alias("units_sold"),
        count_sum("returned_units").alias("units_returned"),
        total(F.col("sold_amount")).alias("total_gross_sales"),
        total(F.col("returned_amount")).alias("total_returns"),
        total(F.col("amount")).alias("net_revenue"),
    )


def sales_kpis(
    facts: DataFrame, year: int | None = None, region: str | None = None, **options: str
) -> DataFrame:
    """Executive figures for one slice: one row, zeros for an empty slice.

    The average order value divides by all invoices less those with a cancelled line.
    """
    sliced = facts.where(sales_slice(year, region, **options))
    return kpis_of(per_invoice(sliced), distinct_count(sliced, "customer_id"))


def kpis_of(invoices: DataFrame, customers: Column) -> DataFrame:
    """The executive figures from one row per invoice and the number of customers."""
    figures = invoices.agg(
        count_sum("lines").alias("total_records"),
        F.count("invoice_no").alias("total_orders"),
        count_sum("sold_units").alias("units_sold"),
        total(F.col("sold_amount")).alias("gross_sales"),
        total(F.col("cancelled_amount")).alias("cancellation_amount"),
        total(F.col("amount")).alias("net_sales"),
        count_sum("cancelled_lines").alias("cancellation_records"),
        F.count(F.when(F.col("has_return") == 1, F.col("invoice_no"))).alias("cancelled_orders"),
        count_sum("guest_lines").alias("guest_records"),
        total(F.col("guest_amount")).alias("guest_sales"),
    )
    orders, cancelled = F.col("total_orders"), F.col("cancelled_orders")
    valid = orders - cancelled
    value = F.when(valid > 0, F.col("gross_sales").cast("double") / valid).otherwise(0.0)
    rate = F.when(orders > 0, cancelled / orders * 100).otherwise(0.0)
    gross, guest = F.col("gross_sales"), F.col("guest_sales")
    return figures.select(
        "*",
        customers.alias("active_customers"),
        valid.alias("valid_orders"),
        value.alias("aov"),
        rate.alias("return_rate_pct"),
        F.when(gross > 0, percent(guest, gross)).otherwise(0).alias("guest_pct"),
    )


def sales_trends(
    facts: DataFrame, year: int | None = None, region: str | None = None, **options: str
) -> DataFrame:
    """Monthly orders, units, money and average order value for one slice."""
    invoices = per_invoice(
        facts.where(sales_slice(year, region, **options)), "transaction_year", "transaction_month"
    )
    return trends_of(invoices)


def trends_of(invoices: DataFrame) -> DataFrame:
    """The monthly trend from one row per month and invoice."""
    return (
        invoices.groupBy("transaction_year", "transaction_month")
        .agg(
            F.count("*").alias("total_orders"),
            count_sum("sold_units").alias("units_sold"),
            total(F.col("sold_amount")).alias("gross_sales"),
            total(F.col("returned_amount")).alias("refunds"),
            total(F.col("amount")).alias("net_sales"),
            ratio(F.sum("sold_amount"), F.sum("has_sale")).alias("avg_order_value"),
        )
        .withColumn(
            "period_ym", period_label(F.col("transaction_year"), F.col("transaction_month"))
        )
        .orderBy("transaction_year", "transaction_month")
    )


def monthly_cumulative(facts: DataFrame) -> DataFrame:
    """Monthly orders and revenue of completed lines with a running total.

    The running window sees one row per calendar month, never fact rows.
    """
    monthly = (
        per_invoice(facts.where(is_completed()), "transaction_year", "transaction_month")
        .groupBy("transaction_year", "transaction_month")
        .agg(
            F.count("*").alias("total_orders"),
            count_sum("units").alias("net_items_sold"),
            total(F.col("amount")).alias("net_monthly_revenue"),
        )
    )
    running = Window.orderBy("transaction_year", "transaction_month")
    return monthly.withColumn(
        "cumulative_revenue", F.sum("net_monthly_revenue").over(running).cast(TOTAL)
    ).orderBy("transaction_year", "transaction_month")


def sales_by_day(facts: DataFrame) -> DataFrame:
    """Completed orders and money per weekday, Sunday = 1."""
    days = facts.where(is_completed()).select(
        "invoice_no",
        "gross_amount",
        F.date_format("invoice_date", "EEEE").alias("day_name"),
        F.dayofweek("invoice_date").alias("day_num"),
    )
    per_order = days.groupBy("day_name", "day_num", "invoice_no").agg(
        F.sum("gross_amount").alias("amount")
    )
    return (
        per_order.groupBy("day_name", "day_num")
        .agg(F.count("*").alias("order_count"), total(F.col("amount")).alias("total_sales"))
        .orderBy("day_num")
    )


def sales_by_hour(facts: DataFrame) -> DataFrame:
    """Completed orders and money per hour of the day."""
    per_order = (
        facts.where(is_completed())
        .groupBy(F.hour("invoice_date").alias("order_hour"), "invoice_no")
        .agg(F.sum("gross_amount").alias("amount"))
    )
    return (
        per_order.groupBy("order_hour")
        .agg(F.count("*").alias("order_count"), total(F.col("amount")).alias("total_sales"))
        .orderBy("order_hour")
    )


def cancellation_analysis(facts: DataFrame) -> DataFrame:
    """Cancelled invoices, their share and the refunded value: one row."""
    return per_invoice(facts).agg(
        count_sum("has_return").alias("total_cancellations"),
        percent(F.sum("has_return"), F.count("*")).alias("cancellation_rate_pct"),
        total(F.col("returned_amount")).alias("total_refunded_value"),
    )


def average_order_value(facts: DataFrame) -> DataFrame:
    """Count, mean, smallest and largest completed invoice: one row."""
    return per_invoice(facts.where(is_completed())).agg(
        F.count("*").alias("completed_invoices"),
        ratio(F.sum("amount"), F.count("*")).alias("avg_order_value"),
        F.min("amount").cast(TOTAL).alias("min_order_value"),
        F.max("amount").cast(TOTAL).alias("max_order_value"),
    )


def guest_vs_registered(facts: DataFrame) -> DataFrame:
    """Invoices, lines and revenue share of guests and registered customers.

    Two rows at most reach the share window.
    """
    invoices = per_invoice(
        facts.where(is_completed()).withColumn("checkout_type", checkout_type()), "checkout_type"
    )
    shares = invoices.groupBy("checkout_type").agg(
        F.count("*").alias("distinct_invoices"),
        count_sum("lines").alias("total_line_items"),
        total(F.col("amount")).alias("total_gross_sales"),
    )
    everything = F.sum("total_gross_sales").over(Window.partitionBy())
    return shares.withColumn("revenue_share_pct", percent(F.col("total_gross_sales"), everything))
