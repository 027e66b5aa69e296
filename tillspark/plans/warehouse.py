"""Warehouse tables: dimensions, fact and masters, loaded repeatably."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspark import constants as K
from tillspark import schemas
from tillspark.operators.dedup import first_per_key
from tillspark.operators.dimensions import (
    customer_states,
    customers_of,
    dim_customers_lake,
    dim_products_lake,
    merged_customer_states,
    merged_product_states,
    product_states,
    products_of,
)
from tillspark.operators.merge import new_rows, touched_partitions, upsert
from tillspark.operators.quality import QualityGateError, require_columns
from tillspark.operators.rollups import table_counts
from tillspark.plans.rolled import ROLLUPS, Kept, Rollups
from tillspark.plans.search import SEARCHED
from tillspark.session import staged, staging
from tillspark.sinks.versions import Change, KeyIndex, TextIndex, Version, VersionedTable, partition_of
from tillspark.sources.lake import lake_partitions, read_lake_partitions, read_or_empty

TABLES = {
    "fact_sales": schemas.FACT_SALES,
    "dim_products": schemas.DIM_PRODUCTS,
    "dim_customers": schemas.DIM_CUSTOMERS,
}


@dataclass(frozen=True)
class Dimension:
    """A dimension, its key, the column that keeps the value loaded first, and its states."""

    key: str
    frozen: str
    states: Kept
    rows: Callable[[DataFrame], DataFrame]


DIMENSIONS = {
    "dim_products": Dimension(
        "stock_code", "first_sold_at", Kept(product_states, merged_product_states, ("stock_code",)), products_of
    ),
    "dim_customers": Dimension(
        "customer_id", "first_order_date", Kept(customer_states, merged_customer_states, ("customer_id",)), customers_of
    ),
}
# additions to a kept table before they are merged into one folder again
STATE_FOLDERS = 24


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A warehouse table as its newest version holds it."""
    return VersionedTable(spark, f"{warehouse}/{name}").read()


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    incoming: DataFrame,
    keys: Sequence[str],
    frozen: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Load ``incoming`` into the table at ``path`` by key and return the stored table.

    Where another load comes first, the merge is made again on top of its version.
    """
    table = VersionedTable(spark, path)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def merged(base: Version) -> DataFrame:
        existing = table.read(base) if base.number else spark.createDataFrame([], declared)
        return upsert(existing.select(*declared.names), incoming, keys, frozen=frozen, order=order)

    return table.replace(merged)


def upsert_partitions(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    incoming: DataFrame,
    keys: Sequence[str],
    partition: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """Keyed load of a partitioned table that rewrites only the partitions it touches.

    ``partition`` has to follow from the key, so that a key never changes its partition.
    """
    table = VersionedTable(spark, path, [partition])
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with staging(spark):
        # looked at twice, for its partitions and for its rows
        batch = staged(incoming, "upsert-batch")
        if not batch.isEmpty():

            def merged(base: Version) -> DataFrame:
                stored = table.read(base) if base.number else spark.createDataFrame([], declared)
                return upsert(touched_partitions(stored, batch, [partition]), batch, keys, order=order)

            table.replace_partitions(merged)
    return read_or_empty(spark, path, declared)


def add_kept(spark: SparkSession, warehouse: str, name: str, kept: Kept) -> VersionedTable:
    """Bring a table that is kept beside the fact up to the fact's newest version.

    Only folders that the fact gained since then are read. The version of the fact is noted in
    the same commit as the rows, so that a load cut short or two loads at once count no row twice.
    """
    fact = VersionedTable(spark, f"{warehouse}/fact_sales", K.SALES_PARTITIONS)
    table = VersionedTable(spark, f"{warehouse}/{name}")

    def change(base: Version) -> Change | None:
        newest, added = fact.added_since(base.notes.get("fact_version", 0))
        if added == []:
            return None
        rebuilt = added is None
        rows = kept.made(fact.read(newest, None if rebuilt else added))
        removed = base.folders if rebuilt else ()
        if not rebuilt and len(base.folders) >= STATE_FOLDERS:
            rows = kept.merged(table.read(base).unionByName(rows))
            removed = base.folders
        folders, _ = table.write(rows, cluster=kept.cluster)
        return Change(folders, removed, rows.schema, {"fact_version": newest.number})

    table.update(change)
    return table


def refresh_rollups(spark: SparkSession, warehouse: str) -> Rollups:
    """Bring the roll-ups up to the fact and return them."""
    return Rollups(*[add_kept(spark, warehouse, name, kept).read() for name, kept in ROLLUPS.items()])


def refresh_dimension(spark: SparkSession, warehouse: str, name: str) -> None:
    """Update the dimension for the keys whose states changed since it was last refreshed."""
    dimension = DIMENSIONS[name]
    states = add_kept(spark, warehouse, f"{name}_states", dimension.states)
    table = VersionedTable(spark, f"{warehouse}/{name}")
    declared = StructType.fromDDL(TABLES[name])

    def change(base: Version) -> Change | None:
        known = base.notes.get("state_version", 0)
        newest, added = states.added_since(known)
        if added == []:
            return None
        changed = states.read(newest)
        if known and added is not None:
            touched = states.read(newest, added).select(F.col(dimension.key).alias("_touched")).distinct()
            changed = changed.join(touched, F.col(dimension.key).eqNullSafe(F.col("_touched")), "left_semi")
        stored = table.read(base) if base.number else spark.createDataFrame([], declared)
        merged = upsert(stored, dimension.rows(changed), [dimension.key], frozen=[dimension.frozen])
        folders, _ = table.write(merged, cluster=[dimension.key])
        return Change(folders, base.folders, merged.schema, {"state_version": newest.number})

    table.update(change)


def refresh_dimensions(spark: SparkSession, warehouse: str) -> None:
    """Bring both dimensions up to the fact; first-seen dates keep the value loaded first.

    Their jobs do not depend on each other and share the cluster.
    """
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        list(pool.map(lambda name: refresh_dimension(spark, warehouse, name), DIMENSIONS))


def load_fact(spark: SparkSession, facts: DataFrame, warehouse: str, notes: dict | None = None) -> int:
    """Append fact rows whose key is not stored yet; returns how many were new.

    Only key columns of files that may hold a key of the batch are read: its months, and of
    these the files whose key range and filter let a key pass.
    """
    table = VersionedTable(spark, f"{warehouse}/fact_sales", K.SALES_PARTITIONS)
    index = KeyIndex(table, K.SALES_KEY)
    batch = require_columns(facts, schemas.FACT_SALES_COLUMNS, K.FORBIDDEN_SALES_COLUMNS)
    months = batch.select(*K.SALES_PARTITIONS).distinct().collect()
    touched = {"/".join(f"{name}={value}" for name, value in row.asDict().items()) for row in months}
    inserted = 0

    def change(base: Version) -> Change | None:
        nonlocal inserted
        before = base.in_partitions(touched)
        if before:
            fresh = new_rows(index.matching(base, before, batch), batch, K.SALES_KEY)
        else:
            fresh = first_per_key(batch, K.SALES_KEY)
        # by invoice inside a month; a customer's or product's lines are found by Parquet's filters
        folders, inserted = table.write(fresh, cluster=K.SALES_KEY[:1], sought=["customer_id", "stock_code"])
        if not folders and not notes:
            return None
        index.add(folders, batch.schema)
        return Change(folders, (), base.schema or batch.schema, notes or {}, frozenset(map(partition_of, folders)))

    table.update(change)
    return inserted


def index_searches(spark: SparkSession, warehouse: str) -> TextIndex:
    """Bring the trigram index of the fact up to its newest version, for ``search.indexed_lines``.

    Apart from the load, which need not wait for it: files without an index are simply read.
    """
    index = TextIndex(VersionedTable(spark, f"{warehouse}/fact_sales", K.SALES_PARTITIONS), SEARCHED)
    index.refresh()
    return index


def warehouse_counts(spark: SparkSession, warehouse: str) -> DataFrame:
    """Rows per warehouse table."""
    return table_counts(
        {name: read_or_empty(spark, f"{warehouse}/{name}", s) for name, s in TABLES.items()}
    )


def require_loaded(counts: DataFrame) -> None:
    """Raise where a warehouse table is empty."""
    empty = [row["table_name"] for row in counts.where("row_count = 0").collect()]
    if empty:
        raise QualityGateError(f"empty warehouse tables: {empty}")


def load_warehouse(spark: SparkSession, lake: str, warehouse: str) -> dict[str, int]:
    """New fact rows, then the dimensions, then counts. Running it again changes nothing.

    A load reads the lake's partitions that changed since the last one, which the fact's newest
    version notes, and brings the dimensions up to the rows that the fact gained.
    """
    held = lake_partitions(spark, lake, K.SALES_PARTITIONS)
    known = VersionedTable(spark, f"{warehouse}/fact_sales").version().notes.get("lake", {})
    changed = sorted(place for place, state in held.items() if known.get(place) != state)
    inserted = 0
    if changed:
        facts = read_lake_partitions(spark, lake, changed).select(*schemas.FACT_SALES_COLUMNS)
        inserted = load_fact(spark, facts, warehouse, {"lake": {**known, **held}})
    refresh_dimensions(spark, warehouse)
    counts = warehouse_counts(spark, warehouse)
    require_loaded(counts)
    rows = {f"{r['table_name']}_count": r["row_count"] for r in counts.collect()}
    return {"fact_rows_inserted": inserted, **rows}


def load_daily_sales(spark: SparkSession, daily: DataFrame, warehouse: str) -> DataFrame:
    """Upsert daily aggregates on their grain, day by day."""
    path = f"{warehouse}/agg_daily_sales"
    return upsert_partitions(
        spark, path, schemas.DAILY_SALES, daily, K.DAILY_SALES_KEY, "sale_date"
    )


def load_order_lines(
    spark: SparkSession, lines: DataFrame, warehouse: str, order: Sequence[str] = ()
) -> DataFrame:
    """Upsert order lines on (order, product), month by month.

    The table is partitioned by the month of the order, which follows from the order: a late
    batch rewrites the months of its own orders and not the whole table.
    """
    batch = lines.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    return upsert_partitions(
        spark, f"{warehouse}/order_lines", batch.schema, batch, K.ORDER_LINE_KEY, "order_month", order
    )


# --- masters -----------------------------------------------------------------------


def master_columns(df: DataFrame, master: str) -> DataFrame:
    """The master's known columns that ``df`` has; ``unit_price`` serves as ``price``."""
    if master == "products" and "price" not in df.columns and "unit_price" in df.columns:
        df = df.withColumnRenamed("unit_price", "price")
    declared = StructType.fromDDL(schemas.MASTERS[master])
    return df.select(*[F.col(f.name).cast(f.dataType) for f in declared if f.name in df.columns])


def sync_master(spark: SparkSession, df: DataFrame, warehouse: str, master: str) -> DataFrame:
    """Upsert a master table; columns the feed lacks keep their stored values."""
    incoming = master_columns(df, master)
    key = incoming.columns[0]
    return upsert_table(spark, f"{warehouse}/{master}", schemas.MASTERS[master], incoming, [key])


def seed_masters(
    spark: SparkSession, feeds: dict[str, DataFrame], warehouse: str
) -> list[str]:
    """Add the rows of each feed whose key its master lacks; stored rows stay as they are."""
    for master, df in feeds.items():
        incoming = master_columns(df, master)
        table = VersionedTable(spark, f"{warehouse}/{master}")
        declared = StructType.fromDDL(schemas.MASTERS[master])

        def change(base: Version) -> Change:
            stored = table.read(base) if base.number else spark.createDataFrame([], declared)
            fresh = new_rows(stored, incoming, [incoming.columns[0]])
            absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in declared if f.name not in fresh.columns]
            folders, _ = table.write(fresh.select("*", *absent).select(*declared.names))
            return Change(folders, (), declared)

        table.update(change)
    return list(feeds)


def create_lake_dimensions(spark: SparkSession, facts: DataFrame, path: str) -> None:
    """Both lake dimensions as tables, visible to SQL as views."""
    for name, build in (("dim_products", dim_products_lake), ("dim_customers", dim_customers_lake)):
        stored = VersionedTable(spark, f"{path}/{name}").replace(lambda base: build(facts))
        stored.createOrReplaceTempView(name)
