"""Tables that are stored the way a join needs them: hashed into buckets by key, sorted inside.

Two tables with the same key and number of buckets are joined bucket by bucket, without moving
either. One bucket is one task, which adaptive execution cannot split; so rows of keys that would
fill a bucket by themselves, and rows without a whole key, are stored apart and joined the usual
way. There are fewer such keys than buckets.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspark.operators.merge import latest_per_key, upsert
from tillspark.session import delete_path, path_exists, read_text, staged, write_text

ROWS_PER_BUCKET = 2_000_000
# a key is stored apart from this many times the rows of an average bucket on
HOT_BUCKETS = 2
HASH_SLOTS = 65536


def bucket_count(rows: int) -> int:
    """A power of two, so that Spark can join tables of different counts, too."""
    return 1 << max(0, -(-rows // ROWS_PER_BUCKET) - 1).bit_length()


def _whole_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


@dataclass(frozen=True)
class BucketedTable:
    """A table at ``path``: ``even`` rows in buckets, and the rows apart from them."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BucketedTable:
        known = json.loads(read_text(spark, f"{path}/_table/layout.json"))
        return cls(spark, path, StructType.fromJson(known["schema"]), tuple(known["keys"]), known["buckets"])

    @property
    def _name(self) -> str:
        return f"bucketed_{hashlib.md5(self.path.encode()).hexdigest()}"

    def even(self) -> DataFrame:
        """Rows in buckets. The catalog of a session forgets them, their layout is known by path."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        place = f"{self.path}/even".replace("'", "\\'")
        self.spark.sql(
            f"create table if not exists {self._name} ({columns}) using parquet"
            f" clustered by ({keys}) sorted by ({keys}) into {self.buckets} buckets location '{place}'"
        )
        return self.spark.table(self._name)

    def apart(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/apart")

    def read(self) -> DataFrame:
        return self.even().unionByName(self.apart())


def _hot_keys(df: DataFrame, keys: Sequence[str], most: float) -> DataFrame:
    """Keys of more than ``most`` rows.

    Rows are counted per slot of hashed keys first: only keys in a slot of so many rows are counted
    one by one. There are fewer such slots than buckets.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(HASH_SLOTS))
    full = df.groupBy(slot.alias("_slot")).count().where(F.col("count") > F.lit(most)).collect()
    inside = slot.isin([r["_slot"] for r in full]) if full else F.lit(False)
    return df.where(inside).groupBy(*keys).count().where(F.col("count") > F.lit(most)).select(*keys)


def write_buckets(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None, hot: bool = True
) -> BucketedTable:
    """Store ``df`` at a new ``path``. It is read several times.

    Tables to be joined need the same number of ``buckets``. Without ``hot`` all rows with a whole
    key go to buckets: for tables with few rows per key.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(path)
    rows = df.count()
    buckets = buckets or bucket_count(rows)
    whole = df.where(_whole_key(keys))
    apart = df.where(~_whole_key(keys))
    if hot:
        hot_keys = staged(_hot_keys(whole, keys, HOT_BUCKETS * rows / buckets), "hot-keys")
        apart = apart.unionByName(whole.join(hot_keys, list(keys), "left_semi"))
        whole = whole.join(hot_keys, list(keys), "left_anti")
    table = BucketedTable(spark, path, df.schema, tuple(keys), buckets)
    placed = whole.select(*df.columns).repartition(buckets, *keys)
    _write_even(table, placed)
    apart.select(*df.columns).write.parquet(f"{path}/apart")
    _note(table)
    return table


def _write_even(table: BucketedTable, rows: DataFrame) -> None:
    keys = list(table.keys)
    writer = rows.write.format("parquet").option("compression", "zstd").option("path", f"{table.path}/even").bucketBy(table.buckets, *keys)
    writer.sortBy(*keys).saveAsTable(table._name)


def _note(table: BucketedTable) -> None:
    layout = {"schema": table.schema.jsonValue(), "keys": table.keys, "buckets": table.buckets}
    write_text(table.spark, f"{table.path}/_table/layout.json", json.dumps(layout))


def with_attributes(lines: BucketedTable, dimension: BucketedTable, attributes: dict[str, str]) -> DataFrame:
    """Left join of bucketed lines to the renamed attributes of a dimension with the same key.

    The buckets of both meet where they are. Of the dimension only rows for the keys stored apart
    are joined a second time.
    """
    key = lines.keys[0]
    wanted = dimension.even().select(
        F.col(dimension.keys[0]).alias("_key"), *[F.col(name).alias(new) for name, new in attributes.items()]
    )
    matched = lines.even().join(wanted, F.col(key) == F.col("_key"), "left")
    apart = lines.apart()
    some = wanted.join(apart.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi")
    return matched.unionByName(apart.join(some, F.col(key) == F.col("_key"), "left")).drop("_key")


def upsert_buckets(table: BucketedTable, incoming: DataFrame, path: str, order: Sequence[str] = ()) -> BucketedTable:
    """The table after a keyed load, written to a new ``path`` with the same layout.

    The batch is brought to the buckets; stored rows stay in theirs, from the read to the write.
    Left to Spark, the wider side would win: with more shuffle partitions than buckets it would
    move the stored rows. Keys that the batch repeats until they would fill a bucket are reduced
    to one row each on the way there.
    """
    keys = list(table.keys)
    columns = [f.name for f in table.schema]
    batch = staged(incoming.select(*[c for c in columns if c in incoming.columns]), "bucket-batch")
    values = [c for c in batch.columns if c not in keys]
    last = F.max(F.struct(*order, *[c for c in values if c not in order], F.lit(True).alias("_present")))
    # keys that the stored table keeps apart stay there
    stored_apart = table.apart()
    own = stored_apart.where(_whole_key(keys)).select(*keys).distinct()
    rows = batch.where(_whole_key(keys)).join(own, keys, "left_anti")
    hot_keys = staged(_hot_keys(rows, keys, HOT_BUCKETS * batch.count() / table.buckets), "hot-batch-keys")
    reduced = latest_per_key(rows.join(hot_keys, keys, "left_semi"), keys, order)
    even = rows.join(hot_keys, keys, "left_anti").unionByName(reduced).repartition(table.buckets, *keys)
    whole = even.groupBy(*[F.col(k).alias(f"_new_{k}") for k in keys]).agg(last.alias("_last"))
    same = reduce(Column.__and__, [F.col(f"_new_{k}") == F.col(k) for k in keys])
    merged = table.even().join(whole, same, "full_outer")
    settled = [
        F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c)
        if c in keys
        else F.when(F.col("_last").isNotNull(), F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c)
        if c in values
        else F.col(c)
        for c in columns
    ]
    new = BucketedTable(table.spark, path, table.schema, table.keys, table.buckets)
    _write_even(new, merged.select(*settled))
    there = batch.join(own, keys, "left_semi").unionByName(batch.where(~_whole_key(keys)))
    upsert(stored_apart, there, keys, order=order).write.parquet(f"{path}/apart")
    _note(new)
    return new


def drop_buckets(table: BucketedTable) -> None:
    """Forget a table and delete its files."""
    table.spark.sql(f"drop table if exists {table._name}")
    delete_path(table.spark, table.path)
