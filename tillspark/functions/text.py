"""Text cleaning and matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to(value: Column, default: str) -> Column:
    """Trimmed text, or ``default`` where it is NULL or blank."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))


def is_blank(value: Column) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return value.isNull() | ~value.rlike(r"(?U)\S")


def title_words(value: Column) -> Column:
    """Title case with runs of whitespace collapsed to one space."""
    return F.initcap(F.regexp_replace(value, r"\s+", " "))


def snake_case(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename all columns to snake case in one projection."""
    return df.toDF(*[snake_case(name) for name in df.columns])


def trim_text_columns(df: DataFrame) -> DataFrame:
    """Trim every string column in one projection."""
    return df.select(
        *[
            F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def any_contains(columns: list[str], term: str, case_sensitive: bool = False) -> Column:
    """True where one of ``columns``, read as text, contains ``term``.

    ``%`` and ``_`` in the term stay wildcards.
    """
    pattern = f"%{term}%"
    found = F.lit(False)
    for name in columns:
        text = F.col(name).cast("string")
        found = found | (text.like(pattern) if case_sensitive else text.ilike(pattern))
    return found
