"""Run telemetry: the current state of every run and the latest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.operators.merge import latest_per_key


def current_runs(records: DataFrame) -> DataFrame:
    """The record written last for each run. Records are only ever appended."""
    return latest_per_key(records, ["run_id"], ["logged_at"])


def pipeline_health(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Latest runs with their duration in seconds."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return (
        runs.orderBy(F.col("start_time").desc(), "run_id")
        .limit(limit)
        .select(
            "run_id",
            "pipeline_name",
            "start_time",
            "end_time",
            seconds.alias("duration_seconds"),
            "status",
            "records_processed",
            "records_rejected",
            "error_message",
        )
    )
