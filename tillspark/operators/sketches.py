"""Distinct counts from sketches that are kept per month and country and merged for any report.

One scan of the fact fills all sketches of its months; a later load adds those of its own rows. A
report over any set of months and countries merges a few KB per group and never reads the fact.
Counts are estimates: with ``LOG_SIZE`` bits of address their standard error is below one percent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 14
STANDARD_ERROR = 1.04 / 2 ** (LOG_SIZE / 2)
GRAIN = ["transaction_year", "transaction_month", "country"]
COUNTED = {"invoice_no": "unique_invoices", "stock_code": "unique_products", "customer_id": "unique_customers"}


def distinct_sketches(facts: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """A sketch of every counted column per group; the fact is scanned once, without distinct rows."""
    return facts.groupBy(*grain).agg(*[F.hll_sketch_agg(c, F.lit(LOG_SIZE)).alias(c) for c in COUNTED])


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, or of everything; equal to those of the rows themselves."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in COUNTED])


def _estimate(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct invoices, products and customers per group."""
    merged = merged_sketches(sketches, by)
    return merged.select(*by, *[_estimate(F.col(c)).alias(name) for c, name in COUNTED.items()])


def within_error(estimate: Column, exact: Column, errors: float = 4) -> Column:
    """Whether an estimate lies within so many standard errors of the exact count."""
    return F.abs(estimate - exact) <= F.ceil(errors * STANDARD_ERROR * exact)
