"""Partitioned Parquet tables, plain or versioned."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspark.session import list_folder, list_states, path_exists
from tillspark.sinks.versions import VersionedTable, is_versioned, partition_of


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return VersionedTable(spark, path).read() if is_versioned(spark, path) else spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The table at ``path`` in the declared column order; empty where nothing was written.

    Of a versioned table the newest version; columns it does not store are NULL.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not path_exists(spark, path):
        return spark.createDataFrame([], declared)
    if not is_versioned(spark, path):
        return spark.read.schema(declared).parquet(path).select(*declared.names)
    rows = VersionedTable(spark, path).read()
    known = [F.col(f.name) if f.name in rows.columns else F.lit(None) for f in declared]
    return rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(known, declared)])


def read_lake(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Partition-aware scan. Filters and columns reach the Parquet reader."""
    df = _stored(spark, path)
    if keep is not None:
        df = df.where(keep)
    return df.select(*columns) if columns else df


def read_partition(
    spark: SparkSession, path: str, schema: str, value: str | None = None, partition: str = "order_date"
) -> DataFrame:
    """One partition, or the whole table; an absent table or partition is empty."""
    df = read_or_empty(spark, path, schema)
    return df if value is None else df.where(F.col(partition) == F.lit(value))


def register_lake(spark: SparkSession, path: str, name: str = "fact_sales") -> DataFrame:
    """The table as a temporary view for plain SQL."""
    df = _stored(spark, path)
    df.createOrReplaceTempView(name)
    return df


def lake_partitions(spark: SparkSession, path: str, partitions: Sequence[str]) -> dict[str, str]:
    """What each partition of a lake holds now, as a digest that changes whenever its files do."""
    if is_versioned(spark, path):
        names = [(partition_of(f), f) for f in VersionedTable(spark, path).version().folders]
    else:
        folders = [""]
        for _ in partitions:
            folders = [f"{f}/{n}".lstrip("/") for f in folders for n in list_folder(spark, f"{path}/{f}") if "=" in n]
        names = [(f, state) for f in folders for state in list_states(spark, f"{path}/{f}")]
    held: dict[str, list[str]] = {}
    for place, name in names:
        held.setdefault(place, []).append(name)
    return {place: hashlib.md5("\n".join(sorted(n)).encode()).hexdigest() for place, n in held.items()}


def read_lake_partitions(spark: SparkSession, path: str, places: Sequence[str]) -> DataFrame:
    """Only the named partitions of a lake."""
    if is_versioned(spark, path):
        table = VersionedTable(spark, path)
        version = table.version()
        return table.read(version, version.in_partitions(places))
    return spark.read.option("basePath", path).parquet(*[f"{path}/{place}" for place in places])
