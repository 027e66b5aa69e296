"""Sales vocabulary: flags, slices, bands and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillspark import constants as K


def cancellation_flag(invoice_no: Column, quantity: Column) -> Column:
    """1 for a cancelled invoice number or a negative quantity, else 0 (also for NULL)."""
    cancelled = invoice_no.startswith(K.CANCELLED_INVOICE_PREFIX) | (quantity < 0)
    return F.when(cancelled, 1).otherwise(0)


def is_completed() -> Column:
    return F.col("is_cancellation") == 0


def is_cancelled() -> Column:
    return F.col("is_cancellation") == 1


def is_guest() -> Column:
    return F.col("customer_id").isNull()


def sales_slice(
    year: int | None = None, region: str | None = None, domestic: str = K.DOMESTIC_COUNTRY
) -> Column:
    """Predicate for one year and/or one region.

    ``region`` is the domestic slice, the international slice, the global slice (no
    filter) or the exact name of a country. Stays a plain predicate, so that it
    reaches partition pruning and the Parquet filters.
    """
    keep = F.lit(True)
    if year:
        keep = keep & (F.col("transaction_year") == year)
    if region == K.DOMESTIC_SLICE:
        keep = keep & (F.col("country") == domestic)
    elif region == K.INTERNATIONAL_SLICE:
        keep = keep & (F.col("country") != domestic)
    elif region and region != K.GLOBAL_SLICE:
        keep = keep & (F.col("country") == region)
    return keep


def band_label(value: Column, bands: Sequence[K.Band], rest: str) -> Column:
    """Label of the first band holding ``value``; gaps and NULL fall to ``rest``."""
    label = F
    for band in bands:
        inside = F.lit(True)
        if band.low is not None:
            inside = inside & (value >= F.lit(band.low))
        if band.high is not None:
            inside = inside & (value <= F.lit(band.high))
        if band.below is not None:
            inside = inside & (value < F.lit(band.below))
        label = label.when(inside, F.lit(band.label))
    return label.otherwise(F.lit(rest))


def order_status() -> Column:
    return F.when(is_cancelled(), K.STATUS_RETURNED).otherwise(K.STATUS_COMPLETED)


def checkout_type() -> Column:
    return F.when(is_guest(), K.GUEST_CHECKOUT).otherwise(K.REGISTERED_CHECKOUT)


def period_label(year: Column, month: Column) -> Column:
    """``yyyy-MM``."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
