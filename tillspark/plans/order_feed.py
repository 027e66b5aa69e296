"""Order feed job: quarantine, clean, enrich, price, audit, write, roll up."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.operators.quality import Checked, check_order_lines, enforce_gate, quality_audit
from tillspark.operators.rollups import daily_sales, daily_summary
from tillspark.plans.order_lines import priced_order_lines
from tillspark.plans.warehouse import load_daily_sales
from tillspark.session import staged
from tillspark.sinks.lake import write_partitions
from tillspark.sinks.reports import write_quarantine, write_report


def admit(
    raw: DataFrame,
    reports: str,
    batch_id: str,
    max_quarantine_pct: float,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """The valid lines of a feed. Rejected ones are quarantined with their reasons.

    Raises after writing quarantine and report where too many lines were rejected.
    """
    checked = check_order_lines(raw, customers, products)
    # three results are read from the checked lines, so they are computed once
    checked = Checked(staged(checked.rows, "checked-orders"), checked.rules, checked.columns)
    report = checked.report(max_quarantine_pct)
    write_quarantine(checked.quarantined(), f"{reports}/quarantine", batch_id)
    write_report(report, f"{reports}/validation/batch={batch_id}")
    enforce_gate(report, max_quarantine_pct)
    return checked.valid()


def process_order_feed(
    spark: SparkSession,
    raw: DataFrame,
    catalog: DataFrame,
    customers: DataFrame,
    lake: str,
    warehouse: str,
    reports: str,
    batch_id: str,
    max_quarantine_pct: float,
    store: str = "store_id",
) -> DataFrame:
    """Run a feed end to end and return its daily summary.

    Lines carry their store in ``store``; transactions are (order, product) pairs.
    """
    started = time.monotonic()
    valid = admit(raw, reports, batch_id, max_quarantine_pct, customers, catalog)
    lines = staged(priced_order_lines(valid, catalog, customers), "priced-orders")
    audited = lines.withColumn("transaction_id", F.concat_ws("-", "order_id", "product_id"))
    audit = quality_audit(audited, raw, store_id=store, transaction_date="order_date")
    written = write_partitions(lines, lake)
    write_report(
        audit.withColumns(
            {
                "output_parquet_location": F.lit(written["target_path"]),
                "processing_duration_seconds": F.lit(round(time.monotonic() - started, 2)),
            }
        ),
        f"{reports}/audit/batch={batch_id}",
    )
    daily = lines.withColumnsRenamed(
        {"order_date": "sale_date", store: "store_id", "product_category": "category"}
    )
    load_daily_sales(spark, daily_sales(daily), warehouse)
    return daily_summary(lines)
