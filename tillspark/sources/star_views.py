"""The star-schema test tables seen as the retail feeds and tables of this package.

Every view covers its whole tables. Projections stay lazy, so a report that needs three
columns reads three columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.constants import PRICE
from tillspark.functions.money import line_amount

GUEST_SEGMENT = "HOUSEHOLD"
HOME_COUNTRY = "NATION_0"
SOURCE_SYSTEM = "STAR_SCHEMA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, nation and part.

    Orders meet customers first: they are fewer than lines, so where neither side can be
    broadcast the lines are shuffled twice (order, part) and not three times.
    """
    headers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def _returned() -> Column:
    return F.col("l_returnflag") == "R"


def _invoice_no() -> Column:
    return F.concat(F.when(_returned(), "C").otherwise(""), F.col("l_orderkey").cast("string"))


def _quantity() -> Column:
    return F.when(_returned(), -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int")


def _price() -> Column:
    return F.col("p_retailprice").cast(PRICE)


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact; invoices of household buyers count as guest invoices."""
    return _ordered_lines(spark, sf_dir).select(
        _invoice_no().alias("invoice_no"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        _quantity().alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        _price().alias("unit_price"),
        F.when(F.col("c_mktsegment") != GUEST_SEGMENT, F.col("o_custkey").cast("int")).alias(
            "customer_id"
        ),
        F.col("n_name").alias("country"),
        line_amount(_quantity(), _price()).alias("gross_amount"),
        F.when(_returned(), 1).otherwise(0).alias("is_cancellation"),
        F.year("o_orderdate").alias("transaction_year"),
        F.month("o_orderdate").alias("transaction_month"),
    )


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text invoice lines. Each region's source writes dates its own way."""
    day = F.col("o_orderdate")
    region = F.col("n_regionkey")
    written = (
        F.when(region == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(region == 1, F.date_format(day, "M/d/yyyy H:mm"))
        .when(region == 2, F.date_format(day, "yyyy-MM-dd"))
        .when(region == 3, F.date_format(day, "dd/MM/yyyy HH:mm"))
        .otherwise("not a date")
    )
    buyer = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    return _ordered_lines(spark, sf_dir).select(
        F.concat(F.lit(" "), _invoice_no(), F.lit(" ")).alias("InvoiceNo"),
        F.concat(F.lit("  p"), F.col("l_partkey").cast("string"), F.lit(" ")).alias("StockCode"),
        F.when(F.col("p_size") == 1, "  ").otherwise(F.col("p_name")).alias("Description"),
        _quantity().alias("Quantity"),
        written.alias("InvoiceDate"),
        _price().alias("UnitPrice"),
        F.when(F.col("c_mktsegment") == GUEST_SEGMENT, "").otherwise(buyer).alias("CustomerID"),
        F.concat(F.lit(" "), F.col("n_name")).alias("Country"),
    )


def timed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one-line orders with a time of day and small prices; errors are cancelled."""
    amount = F.col("value").cast(PRICE)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("invoice_no"),
        F.col("event_type").alias("stock_code"),
        F.lit(1).alias("quantity"),
        F.col("ts").alias("invoice_date"),
        amount.alias("unit_price"),
        line_amount(F.lit(1), amount).alias("gross_amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_cancellation"),
    )


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as run telemetry: each user is a run that reports its state repeatedly."""
    ended = F.timestamp_add("SECOND", F.col("value").cast("int"), F.col("ts"))
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("RUN_"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit("sales_pipeline").alias("pipeline_name"),
        F.col("ts").alias("start_time"),
        ended.alias("end_time"),
        F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"),
        F.col("event_id").alias("records_processed"),
        F.when(failed, 1).otherwise(0).cast("bigint").alias("records_rejected"),
        F.when(failed, F.col("event_type")).alias("error_message"),
        F.col("props").alias("metrics_json"),
        ended.alias("logged_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw all-text order lines with the usual blemishes of a hand-kept feed."""
    regions = table(spark, sf_dir, "region")
    lines = _ordered_lines(spark, sf_dir).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    day = F.col("o_orderdate")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("order_date"),
        F.when(F.col("c_mktsegment") == GUEST_SEGMENT, " ")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        # whole, with a zero fraction, with a fraction that cleaning cuts off
        F.concat(
            _quantity().cast("string"),
            F.when(F.col("l_linenumber") % 3 == 1, ".0").when(F.col("l_linenumber") % 3 == 2, ".7").otherwise(""),
        ).alias("quantity"),
        F.when(F.col("p_size") == 1, "n/a").otherwise(_price().cast("string")).alias("unit_price"),
        F.when(F.col("l_linestatus") == "F", (F.col("l_discount") * 100).cast("decimal(5,2)").cast("string"))
        .alias("discount"),
        F.concat(F.lit(" "), F.lower("r_name"), F.lit("   zone")).alias("region"),
        F.when(F.col("l_linestatus") == "F", "card").otherwise(" ").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "O", "")
        .when(F.col("o_orderstatus") == "F", "in FULL delivery")
        .otherwise("pending")
        .alias("order_status"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd").alias("ingestion_timestamp"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed order lines with their store and category."""
    return _ordered_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.col("p_type").alias("category"),
        _quantity().alias("quantity"),
        _price().alias("unit_price"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount"),
        F.col("o_orderstatus").alias("order_status"),
    )


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock"),
    )


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("city"),
            F.lit(None).cast("string").alias("state"),
            F.col("n_name").alias("country"),
        )
    )


def supplier_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in the shape of a customer master.

    Their numbers are the first of the customers' and parts' numbers, so as a list of known
    ids this whole table leaves most customers and parts without a parent.
    """
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("customer_id"),
            F.col("s_name").alias("customer_name"),
            F.lit(None).cast("string").alias("city"),
            F.lit(None).cast("string").alias("state"),
            F.col("n_name").alias("country"),
        )
    )
