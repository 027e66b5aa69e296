"""Partitioned Parquet writes with verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillspark.constants import SALES_PARTITIONS
from tillspark.sinks.versions import MAX_RECORDS_PER_FILE, Change, VersionedTable
from tillspark.sources.lake import read_lake, read_or_empty


class WriteError(RuntimeError):
    """What was written is not what can be read back."""


def _counting_writer(df: DataFrame, partitions: Sequence[str], *metrics: Column):
    """A partitioned writer, and the observation that counts its rows.

    Rows of a partition meet in few files, and a busy partition is split over tasks: unlike
    a plain repartition by the same columns, the rebalance hint lets adaptive execution cut
    a month that holds a large share of all rows.

    The observation sits above that shuffle, in the stage that writes. There each finished
    task counts once, so a map task repeated after a lost executor cannot count twice.
    """
    written = Observation()
    counted = df.hint("rebalance", *partitions).observe(
        written, F.count(F.lit(1)).alias("rows"), *metrics
    )
    writer = (
        counted.write.option("compression", "snappy")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partitions)
    )
    return writer, written


def write_lake(df: DataFrame, path: str, partitions: Sequence[str] = SALES_PARTITIONS) -> int:
    """Replace the partitioned table by a new version; returns the rows written, counted on the way.

    The new version is written beside the old one, which readers see until it is complete.
    """
    table = VersionedTable(df.sparkSession, path, partitions)
    folders, rows = table.write(df)
    table.update(lambda base: Change(folders, base.folders, df.schema))
    return rows


def verify_lake(
    spark: SparkSession, path: str, expected_rows: int, partition: str = SALES_PARTITIONS[0]
) -> DataFrame:
    """Read back: one row with count and partition values; raises on a mismatch."""
    report = read_lake(spark, path).agg(
        F.count("*").alias("readback_record_count"),
        F.sort_array(F.collect_set(partition)).alias("partition_values"),
    )
    row = report.first()
    if row["readback_record_count"] != expected_rows:
        raise WriteError(f"wrote {expected_rows} rows, read back {row['readback_record_count']}")
    if not row["partition_values"]:
        raise WriteError(f"no {partition} partitions under {path}")
    return report.withColumn("status", F.lit("PASSED"))


def write_partitions(
    df: DataFrame, path: str, partition_by: str = "order_date", mode: str = "overwrite"
) -> dict[str, int | str]:
    """Replace only the partitions present in ``df``, or append; then compare counts.

    The dynamic mode is set on this write alone, not on the session.
    """
    spark = df.sparkSession
    before = 0
    if mode == "append":
        before = read_or_empty(spark, path, df.schema).count()
    # as many values as the table has folders, which the driver lists anyway
    touched_values = F.collect_set(partition_by).alias("touched")
    nulls = F.count_if(F.col(partition_by).isNull()).alias("nulls")
    writer, written = _counting_writer(df, [partition_by], touched_values, nulls)
    writer.mode(mode).option("partitionOverwriteMode", "dynamic").parquet(path)
    expected = before + written.get["rows"]
    stored = spark.read.parquet(path)
    if mode != "append":
        place, touched = F.col(partition_by), written.get["touched"]
        inside = place.isin(touched) if touched else F.lit(False)
        # rows without a value are a folder of their own
        stored = stored.where((place.isNotNull() & inside) | (place.isNull() & F.lit(written.get["nulls"] > 0)))
    actual = stored.count()
    if actual != expected:
        raise WriteError(f"expected {expected} rows in {path}, read back {actual}")
    return {
        "target_path": path,
        "expected_records": expected,
        "verified_records": actual,
        "status": "SUCCESS",
    }
