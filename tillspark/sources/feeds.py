"""CSV feeds: typed invoice lines and all-text order lines."""

from __future__ import annotations

import contextlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.schemas import CORRUPT_RECORD, CUSTOMER_MASTER, PRODUCT_CATALOG, RAW_SALES
from tillspark.session import staged
from tillspark.sources.files import SourceError, require_content


@dataclass(frozen=True)
class RawSales:
    """Well-formed lines, and malformed ones as their original text."""

    lines: DataFrame
    malformed: DataFrame


@contextlib.contextmanager
def header_checked(path: str):
    """Turn the reader's complaint about a file's header into a ``SourceError``."""
    try:
        yield
    except Exception as error:
        if "CSV header does not conform" in str(error) or "Number of column in CSV header" in str(error):
            raise SourceError(f"a file under {path} has other columns than declared: {error}") from error
        raise


def _declared(reader, schema: str, multi_line: bool):
    """CSV with a declared schema; every file's own header has to name the same columns."""
    return (
        reader.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def sales_reader(reader, multi_line: bool = False):
    """A reader, batch or stream, of invoice lines; malformed ones keep their text.

    ``multi_line`` accepts quoted line breaks, at the price of one task per file. Without
    it Spark splits large files.
    """
    return (
        _declared(reader, f"{RAW_SALES}, {CORRUPT_RECORD} string", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    )


def read_raw_sales(spark: SparkSession, path: str, multi_line: bool = False) -> RawSales:
    """Read invoice lines with the declared schema, separating malformed ones.

    The text is parsed once, with every column, into a staged table: what counts as
    malformed then cannot depend on which columns a later query reads. Raises where a file's
    header differs from the declared columns.
    """
    require_content(spark, path)
    with header_checked(path):
        table = staged(sales_reader(spark.read, multi_line).csv(path), "raw-sales")
    corrupt = F.col(CORRUPT_RECORD)
    return RawSales(
        table.where(corrupt.isNull()).drop(CORRUPT_RECORD),
        table.where(corrupt.isNotNull()).select(corrupt.alias("raw_text")),
    )


def with_lineage(df: DataFrame, source_system: str) -> DataFrame:
    """Add the source name and one timestamp for the whole read."""
    return df.withColumns(
        {"source_system": F.lit(source_system), "ingestion_timestamp": F.current_timestamp()}
    )


def read_text_csv(
    spark: SparkSession, path: str, source_system: str = "CSV_SALES", multi_line: bool = False
) -> DataFrame:
    """Every column as text, empties kept as empty text, with file lineage."""
    require_content(spark, path)
    raw = (
        spark.read.option("header", "true")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    kept = raw.select(
        *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns],
        F.col("_metadata.file_name").alias("source_file"),
    )
    return with_lineage(kept, source_system)


def read_catalog(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Product catalog CSV with its declared schema; another header fails when it is read."""
    return _declared(spark.read, PRODUCT_CATALOG, multi_line).csv(path)


def read_customers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Customer master CSV with its declared schema; another header fails when it is read."""
    return _declared(spark.read, CUSTOMER_MASTER, multi_line).csv(path)
