"""File listings and manifests. A listing never reads file contents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceError(ValueError):
    """A source is missing, empty or not what its manifest says."""


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file: path, length, modificationTime."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        return reader.load(path).select("path", "length", "modificationTime")
    except AnalysisException as error:
        raise SourceError(f"no such path: {path}") from error


def latest_file(spark: SparkSession, path: str, pattern: str = "*.csv") -> str | None:
    """Path of the newest matching file, or None where there is none."""
    newest = list_files(spark, path, pattern).orderBy(
        F.col("modificationTime").desc(), F.col("path").desc()
    )
    row = newest.first()
    return row["path"] if row else None


def require_content(spark: SparkSession, path: str, min_bytes: int = 1) -> int:
    """Total bytes under ``path``; raises where that is below ``min_bytes``."""
    size = list_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    if size < min_bytes:
        raise SourceError(f"{path} holds {size} bytes, expected at least {min_bytes}")
    return size


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of each file. One file is one row of one task, so Spark refuses files
    over 2 GiB with an error; ``source_manifest`` has a proof of content for any size."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", F.sha2("content", 256).alias("sha256"))


def _header_columns(line: Column) -> Column:
    """Names in a CSV header line."""
    names = F.split(F.regexp_replace(line, "^\ufeff", ""), ',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    return F.transform(names, lambda n: F.regexp_replace(F.trim(n), '^"|"$', ""))


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Per file: its first line, and a checksum over all text lines. Splits inside files.

    The checksum is the number of lines and the sum of their 64-bit hashes, so neither equal
    lines nor their order can cancel out.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    first_block = F.col("_metadata.file_block_start") == 0
    return (
        lines.select(
            F.col("_metadata.file_path").alias("path"),
            F.xxhash64("value").cast("decimal(20,0)").alias("_hash"),
            F.when(first_block, F.struct(F.monotonically_increasing_id().alias("n"), "value")).alias("_first"),
        )
        .groupBy("path")
        .agg(
            F.concat_ws(":", F.count("*"), F.sum("_hash")).alias("line_checksum"),
            F.min("_first")["value"].alias("first_line"),
        )
    )


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(path, checksum) of each file of a feed; an empty file has the checksum of no lines."""
    files = list_files(spark, path).select("path")
    lines = _text_lines(spark, path).select("path", F.col("line_checksum").alias("checksum"))
    return files.join(lines, "path", "left").withColumn("checksum", F.coalesce("checksum", F.lit("0")))


def _record_counts(spark: SparkSession, path: str, header: bool, multi_line: bool) -> DataFrame:
    """Per file: records as the CSV reader counts them."""
    records = (
        spark.read.schema("first_field string")
        .option("header", header)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", "true")
        .csv(path)
    )
    return records.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("record_count"))


def source_manifest(
    spark: SparkSession, path: str, header: bool = True, multi_line: bool = False, sha256: bool = False
) -> DataFrame:
    """Per file of a CSV feed: bytes, records, line checksum and the columns of its own header.

    ``multi_line`` has to be what the feed is read with. ``sha256`` adds a digest of each file
    (see ``file_digests`` for its size limit).
    """
    columns = _header_columns(F.col("first_line")) if header else F.array().cast("array<string>")
    manifest = (
        list_files(spark, path)
        .select("path", F.col("length").alias("file_bytes"))
        .join(_text_lines(spark, path), "path", "left")
        .join(_record_counts(spark, path, header, multi_line), "path", "left")
        .select(
            "path",
            "file_bytes",
            F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count"),
            "line_checksum",
            F.coalesce(columns, F.array().cast("array<string>")).alias("columns"),
        )
        .withColumn("column_count", F.size("columns"))
    )
    return manifest.join(file_digests(spark, path), "path", "left") if sha256 else manifest


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest written by ``source_manifest`` or kept as one JSON document."""
    return spark.read.option("multiLine", "true").json(path)


# other names a manifest document may use for the same facts
DOCUMENT_NAMES = {"csv_file_bytes": "file_bytes", "sha256_csv": "sha256"}
COMPARED = ("file_bytes", "sha256", "record_count", "line_checksum", "column_count", "columns")


def _as_one_file(manifest: DataFrame) -> DataFrame:
    """A manifest without paths speaks of the feed as a whole."""
    folded = {
        "file_bytes": F.sum("file_bytes"),
        "record_count": F.sum("record_count"),
        "columns": F.min("columns"),
        "column_count": F.min("column_count"),
        "sha256": F.min("sha256"),
        "line_checksum": F.min("line_checksum"),
    }
    known = [folded[c].alias(c) for c in COMPARED if c in manifest.columns]
    return manifest.agg(F.lit("").alias("path"), *known)


def manifest_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per file and attribute that differs; a missing file differs in all.

    Only attributes that both sides have are compared. A document without paths is compared
    with the feed's totals, its columns with those of the feed's files.
    """
    expected = expected.withColumnsRenamed(DOCUMENT_NAMES)
    if "path" not in expected.columns:
        expected, actual = expected.withColumn("path", F.lit("")), _as_one_file(actual)
    compared = [c for c in COMPARED if c in expected.columns and c in actual.columns]

    def shown(side: str, name: str) -> Column:
        value = F.col(f"{side}.{name}")
        return F.to_json(value) if name == "columns" else value.cast("string")

    joined = expected.alias("e").join(actual.alias("a"), "path", "full_outer")
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("attribute"), shown("e", c).alias("expected"), shown("a", c).alias("actual"))
            for c in compared
        ]
    )
    return joined.select("path", F.inline(pairs)).where(
        ~F.col("expected").eqNullSafe(F.col("actual"))
    )
