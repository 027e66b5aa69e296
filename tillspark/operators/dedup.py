"""Deterministic keyed dedup that stays flat under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate rather than a ranking window: each task first reduces its own rows to
    one per key, so a key holding a large share of the table is no larger than any other
    once it is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order]
    if not ranked:
        return df.distinct()
    survivor = F.min(F.struct(*ranked)).alias("_row")
    return df.groupBy(*keys).agg(survivor).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")
