"""Raw invoice lines to the curated sales fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.money import line_amount
from tillspark.functions.once import with_columns_once
from tillspark.functions.parsing import nullable_id, parse_timestamp
from tillspark.functions.sales import cancellation_flag
from tillspark.functions.text import blank_to
from tillspark.operators.dedup import first_per_key
from tillspark.schemas import CORRUPT_RECORD, FACT_SALES_COLUMNS, RAW_SALES_COLUMNS
from tillspark.session import staged


def typed_sales(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Clean and type every raw line; nothing is filtered yet."""
    parsed = with_columns_once(raw, _parsed_date=parse_timestamp(F.col("InvoiceDate")))
    return parsed.select(
        F.trim("InvoiceNo").alias("invoice_no"),
        F.upper(F.trim("StockCode")).alias("stock_code"),
        blank_to(F.col("Description"), K.UNKNOWN_DESCRIPTION).alias("description"),
        F.col("Quantity").cast("int").alias("quantity"),
        F.col("_parsed_date").alias("invoice_date"),
        F.col("UnitPrice").cast(K.PRICE).alias("unit_price"),
        nullable_id(F.col("CustomerID")).alias("customer_id"),
        blank_to(F.col("Country"), K.UNKNOWN_COUNTRY).alias("country"),
        *carry,
    )


def is_usable() -> Column:
    """Rows need an invoice number and a readable date; a blank number passes."""
    return F.col("invoice_no").isNotNull() & F.col("invoice_date").isNotNull()


def derived_sales(typed: DataFrame, source_system: str, ingested_at: Column) -> DataFrame:
    """Add flag, amount, partition keys and lineage in the curated column order."""
    return typed.select(
        *typed.columns,
        line_amount(F.col("quantity"), F.col("unit_price")).alias("gross_amount"),
        cancellation_flag(F.col("invoice_no"), F.col("quantity")).alias("is_cancellation"),
        F.year("invoice_date").alias("transaction_year"),
        F.month("invoice_date").alias("transaction_month"),
        F.lit(source_system).alias("source_system"),
        ingested_at.alias("ingestion_timestamp"),
    ).select(*FACT_SALES_COLUMNS)


def curate(
    raw: DataFrame, source_system: str = "RETAIL_FEED", ingested_at: Column | None = None
) -> DataFrame:
    """Usable raw lines, typed, derived and deduplicated on the natural key."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    usable = typed_sales(raw).where(is_usable())
    return first_per_key(derived_sales(usable, source_system, stamp), K.SALES_KEY)


def _rejected(typed: DataFrame) -> DataFrame:
    """Typed lines that cannot be curated, with the reason and the date as it was written."""
    reason = F.concat_ws(
        "; ",
        F.when(F.col("invoice_no").isNull(), "missing invoice number"),
        F.when(F.col("invoice_date").isNull(), "unreadable invoice date"),
    )
    return (
        typed.where(~is_usable())
        .withColumn("reject_reason", reason)
        .drop("invoice_date")
        .withColumnRenamed("_raw_date", "raw_invoice_date")
    )


def rejected_sales(raw: DataFrame) -> DataFrame:
    """Raw lines that cannot be curated, with the reason."""
    return _rejected(
        typed_sales(raw.withColumn("_raw_date", F.col("InvoiceDate")), carry=("_raw_date",))
    )


@dataclass(frozen=True)
class TypedFeed:
    """A parsed feed, typed and written once, and the counts taken on the way.

    ``counts`` holds the lines (``total``), ``malformed`` and ``rejected`` ones and, per raw
    column, the NULLs of the well-formed lines (``null_<column>``).
    """

    table: DataFrame
    counts: dict[str, int]

    def curated(self, source_system: str, ingested_at: Column) -> DataFrame:
        usable = self._well_formed().drop("_raw_date").where(is_usable())
        return first_per_key(derived_sales(usable, source_system, ingested_at), K.SALES_KEY)

    def rejected(self) -> DataFrame:
        return _rejected(self._well_formed())

    def malformed(self) -> DataFrame:
        return self.table.where(F.col(CORRUPT_RECORD).isNotNull()).select(F.col(CORRUPT_RECORD).alias("raw_text"))

    def _well_formed(self) -> DataFrame:
        return self.table.where(F.col(CORRUPT_RECORD).isNull()).drop(CORRUPT_RECORD)


def typed_feed(parsed: DataFrame) -> TypedFeed:
    """Type every parsed line once; curation, rejects and counts all come from that table."""
    good = F.col(CORRUPT_RECORD).isNull()
    read, checked = Observation(), Observation()
    lines = parsed.observe(
        read,
        F.count(F.lit(1)).alias("total"),
        F.count_if(~good).alias("malformed"),
        *[F.count_if(good & F.col(c).isNull()).alias(f"null_{c}") for c in RAW_SALES_COLUMNS],
    )
    typed = typed_sales(lines.withColumn("_raw_date", F.col("InvoiceDate")), carry=("_raw_date", CORRUPT_RECORD))
    counted = typed.observe(checked, F.count_if(good & ~is_usable()).alias("rejected"))
    return TypedFeed(staged(counted, "typed-sales"), {**read.get, **checked.get})


def curation_counters(raw: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    """One row: raw, malformed, rejected, duplicate and curated line counts.

    ``raw`` holds the well-formed lines. Key groups are counted by an aggregate over the
    key, so the counters need no second look at the deduplicated rows.
    """
    keyed = typed_sales(raw).groupBy(*K.SALES_KEY).agg(F.count("*").alias("_rows"))
    counted = keyed.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("parsed_records"),
        F.coalesce(F.sum(F.when(~is_usable(), F.col("_rows"))), F.lit(0)).alias("rejected_records"),
        F.count_if(is_usable()).alias("final_curated_records"),
    )
    bad = F.lit(0).cast("bigint") if malformed is None else malformed.agg(F.count("*")).scalar()
    return counted.select(
        (F.col("parsed_records") + bad).alias("initial_raw_records"),
        bad.alias("malformed_records"),
        "rejected_records",
        (F.col("parsed_records") - F.col("rejected_records") - F.col("final_curated_records")).alias(
            "duplicates_removed"
        ),
        "final_curated_records",
    )
