"""Keyed merges: upsert with an optional frozen column list, and insert-ignore."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.operators.dedup import first_per_key

_BATCH_KEY = "_batch_{}".format


def _same_key(keys: Sequence[str]) -> Column:
    """Equal keys, where NULL equals NULL: a row with a blank key part is stored once too."""
    condition = F.lit(True)
    for key in keys:
        condition &= F.col(key).eqNullSafe(F.col(_BATCH_KEY(key)))
    return condition


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    *,
    frozen: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """The table after loading ``incoming`` into ``existing``.

    Keys may be NULL in part; NULL equals NULL, so a repeated load changes nothing.
    Per key the last incoming row (by ``order``, ties by the remaining columns) replaces
    the stored one, NULLs included. ``frozen`` columns, and columns the batch does not
    carry, keep the value that was stored first.

    The batch is reduced to one row per key before it meets the table, so a key repeated
    many times is settled on the map side and neither side of the join has a hot key. The
    reduced batch is already placed and sorted by key; only the table is shuffled for it.
    """
    columns = existing.columns
    carried = [c for c in columns if c in incoming.columns]
    missing = [k for k in keys if k not in carried]
    if missing:
        raise ValueError(f"batch lacks key columns {missing}")
    values = [c for c in carried if c not in keys]
    kept = [c for c in values if c in frozen]
    row = F.struct(*order, *[c for c in values if c not in order], F.lit(True).alias("_present"))
    sides = [F.max(row).alias("_last")] + ([F.min(row).alias("_first")] if kept else [])
    batch = incoming.groupBy(*[F.col(k).alias(_BATCH_KEY(k)) for k in keys]).agg(*sides)
    stored = existing.withColumn("_stored", F.lit(True))

    def settled(name: str) -> Column:
        if name in keys:
            return F.when(F.col("_stored"), F.col(name)).otherwise(F.col(_BATCH_KEY(name)))
        if name in kept:
            return F.when(F.col("_stored"), F.col(name)).otherwise(F.col(f"_first.{name}"))
        if name in values:
            return F.when(F.col("_last").isNotNull(), F.col(f"_last.{name}")).otherwise(F.col(name))
        return F.col(name)

    merged = stored.join(batch, _same_key(keys), "full_outer")
    return merged.select(*[settled(c).alias(c) for c in columns])


def touched_partitions(
    existing: DataFrame, incoming: DataFrame, partitions: Sequence[str]
) -> DataFrame:
    """The partitions of ``existing`` that ``incoming`` has rows for.

    The list goes through the driver as a plain filter, so the other folders are never
    listed for reading. It is bounded by the table's own folder list, which the driver
    holds anyway; a join filter would only prune where the batch itself has a predicate.
    """
    # a NULL partition value is a place of its own
    place = F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("\0")) for p in partitions])
    touched = [row[0] for row in incoming.select(place).distinct().collect()]
    return existing.where(place.isin(touched) if touched else F.lit(False))


def new_rows(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], *, order: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``incoming`` to append so that every key is stored once, first come.

    Only the key columns of ``existing`` are read.
    """
    stored = existing.select(*[F.col(k).alias(_BATCH_KEY(k)) for k in keys])
    return first_per_key(incoming, keys, order).join(stored, _same_key(keys), "left_anti")


def insert_ignore(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], *, order: Sequence[str] = ()
) -> DataFrame:
    """The whole table after an insert-ignore load."""
    return existing.unionByName(new_rows(existing, incoming, keys, order=order))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``, ties by the remaining columns."""
    ranked = list(order) + [c for c in df.columns if c not in keys and c not in order]
    return df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
