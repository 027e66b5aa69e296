"""Dimension joins and referential checks.

No broadcast is forced. Spark broadcasts a dimension while its measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution re-checks that with real
sizes. Beyond it the join is a shuffle join whose hot product, customer or NULL partition
adaptive execution splits (the fact is always the splittable, left side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# attribute of the dimension -> column of the enriched lines
PRODUCT_ATTRIBUTES = {
    "product_name": "product_name",
    "category": "product_category",
    "brand": "product_brand",
    "price": "catalog_price",
    "stock": "catalog_stock",
}
CUSTOMER_ATTRIBUTES = {
    "customer_name": "customer_name",
    "city": "customer_city",
    "state": "customer_state",
    "country": "customer_country",
}


def with_attributes(
    lines: DataFrame, dimension: DataFrame, key: str, attributes: dict[str, str]
) -> DataFrame:
    """Left join of lines to a dimension's renamed attributes; repeated keys fan out."""
    wanted = dimension.select(
        F.col(key).alias("_key"), *[F.col(name).alias(new) for name, new in attributes.items()]
    )
    return lines.join(wanted, F.col(key) == F.col("_key"), "left").drop("_key")


def with_products(lines: DataFrame, catalog: DataFrame) -> DataFrame:
    return with_attributes(lines, catalog, "product_id", PRODUCT_ATTRIBUTES)


def with_customers(lines: DataFrame, customers: DataFrame) -> DataFrame:
    return with_attributes(lines, customers, "customer_id", CUSTOMER_ATTRIBUTES)


def enrich_order_lines(
    lines: DataFrame, catalog: DataFrame, customers: DataFrame
) -> DataFrame:
    """Order lines with product and customer attributes."""
    return with_customers(with_products(lines, catalog), customers)


def orphan_rows(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-NULL key has no parent."""
    known = parents.select(F.col(parent_key).alias("_known"))
    return df.where(F.col(key).isNotNull()).join(
        known, F.col(key) == F.col("_known"), "left_anti"
    )


def orphan_keys(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Distinct orphan keys with their number of rows.

    Rows are counted per key before the join, so a hot key crosses it as one row.
    """
    counted = (
        df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    )
    return orphan_rows(counted, key, parents, parent_key)


def orphan_key_count(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """One row: number of distinct orphan keys."""
    return orphan_keys(df, key, parents, parent_key).agg(F.count("*").alias("orphan_count"))


def unmatched_after_enrichment(enriched: DataFrame, attribute: str = "customer_name") -> DataFrame:
    """Enriched rows whose dimension attribute stayed NULL."""
    return enriched.where(F.col(attribute).isNull())
