"""Text to typed values. Unparseable input becomes NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillspark.constants import INVOICE_DATE_FORMATS


# what the text of each pattern field can look like; a field not listed may be anything
_FIELD_TEXT = {
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"(0[1-9]|1[0-2])",
    "M": r"0*([1-9]|1[0-2])",
    "dd": r"(0[1-9]|[12]\d|3[01])",
    "d": r"0*([1-9]|[12]\d|3[01])",
    "HH": r"([01]\d|2[0-3])",
    "H": r"0*(\d|1\d|2[0-3])",
    "mm": r"[0-5]\d",
    "ss": r"[0-5]\d",
}


# formats whose every text means the same to a plain cast, which is several times faster
_CASTABLE = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def _may_fit(text: Column, fmt: str) -> Column:
    """Necessary condition for ``text`` to parse as ``fmt``."""
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]+", fmt)
    shape = "".join(
        _FIELD_TEXT.get(part, ".*") if part[0].isalpha() else re.escape(part) for part in parts
    )
    return text.rlike(rf"^{shape}\z")


def _parse_as(text: Column, fmt: str) -> Column:
    if fmt in _CASTABLE:
        return text.try_cast("timestamp")
    return F.try_to_timestamp(text, F.lit(fmt))


def parse_timestamp(text: Column, formats: Sequence[str] = INVOICE_DATE_FORMATS) -> Column:
    """The first of ``formats`` that fits decides.

    A failed parse raises and catches inside Spark, which costs many times a successful
    one. Formats the text cannot have are ruled out first, so failures become rare.
    """
    return F.coalesce(*[F.when(_may_fit(text, fmt), _parse_as(text, fmt)) for fmt in formats])


def parse_order_date(text: Column) -> Column:
    """Date from text such as ``2024-01-02`` or ``2024/01/02``."""
    return F.replace(text, F.lit("/"), F.lit("-")).try_cast("date")


def parse_ymd(text: Column) -> Column:
    """Date from year, month and day alone; month and day may be unpadded."""
    dashed = F.replace(F.trim(text), F.lit("/"), F.lit("-"))
    return F.when(dashed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), dashed.try_cast("date"))


def nullable_id(text: Column) -> Column:
    """Integer id from text such as ``17850`` or ``17850.0``; blank is NULL."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("double").try_cast("int")


def whole_number(text: Column, type_name: str = "int") -> Column:
    """Whole number from text such as ``2`` or ``2.0``; a fraction is cut off."""
    return text.try_cast("double").try_cast(type_name)


def decimal_or(text: Column, type_name: str, default: str | None = None) -> Column:
    """Decimal from text; ``default`` keeps the decimal type, unlike a float literal."""
    value = text.try_cast(type_name)
    return value if default is None else F.coalesce(value, F.lit(default).cast(type_name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating point columns becomes NULL, so a load stores a real NULL."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
