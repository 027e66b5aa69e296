"""Order line search and the totals of a search result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.functions.money import total
from tillspark.functions.sales import is_cancelled, is_completed, order_status, sales_slice
from tillspark.functions.text import any_contains
from tillspark.sinks.versions import TextIndex, VersionedTable

SEARCHED = ["invoice_no", "stock_code", "description", "customer_id"]


def matching_lines(
    facts: DataFrame,
    text: str | None = None,
    country: str | None = None,
    status: str | None = None,
    case_sensitive: bool = False,
) -> DataFrame:
    """Sales lines by text, country and status; every filter is optional."""
    keep = F.lit(True)
    if text:
        keep = keep & any_contains(SEARCHED, text, case_sensitive)
    if country and country != K.GLOBAL_SLICE:
        keep = keep & (F.col("country") == country)
    if status == K.COMPLETED_ORDERS:
        keep = keep & is_completed()
    elif status == K.RETURNED_ORDERS:
        keep = keep & is_cancelled()
    return facts.where(keep)


def order_search(facts: DataFrame, limit: int = 50, **filters) -> DataFrame:
    """Newest matching lines, at most ``limit``."""
    return newest_lines(matching_lines(facts, **filters), limit)


def newest_lines(lines: DataFrame, limit: int = 50) -> DataFrame:
    """Search results as they are shown, newest first."""
    shown = [
        "invoice_no", "invoice_date", "customer_id", "country", "stock_code",
        "description", "quantity", "unit_price", "gross_amount",
    ]
    ties = ["invoice_no", "stock_code", "quantity", "unit_price", "customer_id", "country"]
    return (
        lines.select(*shown, order_status().alias("order_status"))
        .orderBy(F.col("invoice_date").desc(), *ties)
        .limit(limit)
    )


def indexed_lines(table: VersionedTable, text: str | None = None, **filters) -> DataFrame:
    """``matching_lines`` of a stored fact, from the files whose trigrams let ``text`` pass.

    The index only leaves files out; every row is checked as without it.
    """
    version = table.version()
    facts = TextIndex(table, SEARCHED).containing(version, text) if text else table.read(version)
    return matching_lines(facts, text=text, **filters)


def result_totals(lines: DataFrame) -> DataFrame:
    """Rows and gross amount of a search result: one row."""
    return lines.agg(
        F.count("*").alias("record_count"), total(F.col("gross_amount")).alias("gross_sales")
    )
