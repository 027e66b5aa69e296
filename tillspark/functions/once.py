"""Columns that must be evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add ``columns``, each computed exactly once per row.

    A filter on an ordinary computed column is moved below the projection, where it
    computes the column again together with everything the column was made from. For
    text parsing that doubles the work of a scan. A filter cannot move below a generator,
    so these columns come out of a one-row ``inline``.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
