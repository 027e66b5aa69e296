"""Financial columns, daily roll-ups and one-pass table metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tillspark.functions.money import discount_amount, line_amount, total
from tillspark.functions.sales import is_cancelled, is_guest
from tillspark.operators.sketches import COUNTED, LOG_SIZE
from tillspark.session import dealt_by, staged


def with_financials(lines: DataFrame) -> DataFrame:
    """Add gross, discount (percentage points) and net amount to order lines."""
    gross = line_amount(F.col("quantity"), F.col("unit_price"))
    discount = discount_amount(gross, F.col("discount"))
    return lines.select(
        *[c for c in lines.columns if c not in ("gross_amount", "discount_amount", "net_amount")],
        gross.alias("gross_amount"),
        discount.alias("discount_amount"),
        (gross - discount).try_cast("decimal(12,2)").alias("net_amount"),
    )


def with_distinct_count(
    groups: DataFrame, rows: DataFrame, by: str, counted: str, name: str
) -> DataFrame:
    """Add the number of distinct ``counted`` values of ``rows`` in each group of ``by``.

    A second, narrow scan: two columns are made distinct on the map side first. Counting
    several things distinctly in one aggregate would copy every row once for each.
    """
    pairs = rows.select(F.col(by).alias("_by"), counted).distinct()
    counts = pairs.groupBy("_by").agg(F.count(counted).alias(name))
    return groups.join(counts, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def distinct_count(rows: DataFrame, name: str) -> Column:
    """Number of distinct values of a column, from a narrow scan of its own."""
    return rows.select(name).distinct().agg(F.count(name)).scalar()


def daily_summary(lines: DataFrame) -> DataFrame:
    """Per order date: distinct orders and customers, items and money, newest first."""
    per_order = lines.groupBy("order_date", "order_id").agg(
        F.sum("quantity").alias("items"),
        F.sum("gross_amount").alias("gross"),
        F.sum("discount_amount").alias("discount"),
        F.sum("net_amount").alias("net"),
    )
    days = (
        per_order.groupBy("order_date")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("items").cast("bigint").alias("total_items"),
            total(F.col("gross")).alias("gross_revenue"),
            total(F.col("discount")).alias("total_discounts"),
            total(F.col("net")).alias("net_revenue"),
        )
    )
    return with_distinct_count(days, lines, "order_date", "customer_id", "unique_customers").orderBy(
        F.col("order_date").desc()
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    """Aggregate at (date, store, category) grain.

    Reduced to orders first, so that a busy store is many small groups in the shuffle. Lines of
    an order seldom share their group, so a reduction before that shuffle would fill memory for
    nothing: lines are dealt out first, the more widely the larger their files are.
    """
    dealt = dealt_by(lines, "sale_date", "store_id", "category", "order_id")
    per_order = dealt.groupBy("sale_date", "store_id", "category", "order_id").agg(
        F.sum("quantity").alias("items"),
        F.sum("gross_amount").alias("gross"),
        F.sum("discount_amount").alias("discount"),
        F.sum("net_amount").alias("net"),
    )
    return per_order.groupBy("sale_date", "store_id", "category").agg(
        F.count("*").alias("total_orders"),
        F.sum("items").cast("bigint").alias("total_items_sold"),
        total(F.col("gross")).alias("gross_revenue"),
        total(F.col("discount")).alias("total_discount"),
        total(F.col("net")).alias("net_revenue"),
    )


METRIC_COLUMNS = ["invoice_no", "stock_code", "customer_id", "invoice_date", "gross_amount", "is_cancellation"]


def curation_metrics(facts: DataFrame, stored: bool = False) -> DataFrame:
    """One row of run metrics over the curated fact.

    Three scans of a few columns each: what is computed and not ``stored`` is staged first,
    so that parsing, joins and dedup run once.
    """
    if not stored:
        facts = staged(facts.select(*METRIC_COLUMNS), "curated-metrics")
    counted = _metric_sums(facts.groupBy("invoice_no"), F.count("invoice_no"))
    return counted.select(
        "total_records",
        "unique_invoices",
        distinct_count(facts, "stock_code").alias("unique_products"),
        distinct_count(facts, "customer_id").alias("unique_customers"),
        "guest_order_records",
        "cancellation_records",
        "min_invoice_date",
        "max_invoice_date",
        "total_gross_amount",
    )


def _metric_sums(groups: GroupedData, invoices: Column) -> DataFrame:
    """Sums over groups of lines first, then over the groups."""
    parts = groups.agg(
        F.count("*").alias("lines"),
        F.count_if(is_guest()).alias("guests"),
        F.count_if(is_cancelled()).alias("cancelled"),
        F.min("invoice_date").alias("first"),
        F.max("invoice_date").alias("last"),
        F.sum("gross_amount").alias("amount"),
    )
    return parts.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_records"),
        invoices.alias("unique_invoices"),
        F.coalesce(F.sum("guests"), F.lit(0)).alias("guest_order_records"),
        F.coalesce(F.sum("cancelled"), F.lit(0)).alias("cancellation_records"),
        F.min("first").alias("min_invoice_date"),
        F.max("last").alias("max_invoice_date"),
        total(F.col("amount")).alias("total_gross_amount"),
    )


def approximate_metrics(facts: DataFrame) -> DataFrame:
    """The run metrics in one scan, distinct counts estimated: for facts too large to count exactly."""
    sums = {
        "total_records": F.count("*"),
        "guest_order_records": F.count_if(is_guest()),
        "cancellation_records": F.count_if(is_cancelled()),
        "min_invoice_date": F.min("invoice_date"),
        "max_invoice_date": F.max("invoice_date"),
        "total_gross_amount": total(F.col("gross_amount")),
    }
    distinct = {
        name: F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(LOG_SIZE))) for c, name in COUNTED.items()
    }
    found = facts.agg(*[c.alias(n) for n, c in {**sums, **distinct}.items()])
    return found.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("bigint") for n in distinct})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
