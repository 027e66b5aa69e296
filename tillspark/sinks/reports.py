"""JSON reports, quarantine, CSV export and the run log."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.plans.health import current_runs
from tillspark.schemas import RUN_LOG
from tillspark.sources.lake import read_or_empty

logger = logging.getLogger(__name__)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON file, stamped with the time it was made."""
    stamped = report.withColumn("execution_timestamp", F.current_timestamp())
    stamped.coalesce(1).write.mode("overwrite").json(path)


def write_quarantine(rows: DataFrame, path: str, batch_id: str) -> None:
    """Rejected rows of one batch as JSON. Writing the batch again replaces it."""
    stamped = rows.withColumns(
        {"quarantined_at": F.current_timestamp(), "batch_id": F.lit(batch_id)}
    )
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .json(path)
    )


def export_csv(result: DataFrame, path: str) -> None:
    """A filtered result as CSV with a header."""
    result.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    pipeline_name: str,
    start_time: datetime,
    end_time: datetime | None,
    status: str,
    records_processed: int = 0,
    records_rejected: int = 0,
    error_message: str | None = None,
    metrics: dict | None = None,
) -> bool:
    """Append one run record. A failure to log is reported, never raised."""
    record = (
        run_id, pipeline_name, start_time, end_time, status, records_processed,
        records_rejected, error_message, json.dumps(metrics) if metrics else None,
        datetime.now(timezone.utc),
    )
    try:
        spark.createDataFrame([record], RUN_LOG).coalesce(1).write.mode("append").parquet(path)
        return True
    except Exception:  # telemetry must not fail the run it describes
        logger.exception("run %s could not be logged", run_id)
        return False


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The current state of every logged run."""
    return current_runs(read_or_empty(spark, path, RUN_LOG))
