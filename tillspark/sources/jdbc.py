"""Master tables from a relational database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillspark.sources.feeds import with_lineage

SOURCE_SYSTEM = "MYSQL_MASTER"


def jdbc_options(
    url: str,
    table: str,
    column: str,
    bounds: tuple[int, int],
    partitions: int,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options. A read is always split into ranges of ``column``: one task per range."""
    return {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
        **extra,
    }


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """One table with lineage columns."""
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, **options))
    return with_lineage(reader.load(), SOURCE_SYSTEM)


def read_customers(spark: SparkSession, url: str, **options) -> DataFrame:
    return read_table(spark, url, "customers", **options)


def read_products(spark: SparkSession, url: str, **options) -> DataFrame:
    return read_table(spark, url, "products", **options)


def read_stores(spark: SparkSession, url: str, **options) -> DataFrame:
    return read_table(spark, url, "stores", **options)
