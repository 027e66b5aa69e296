"""Keep a lake equal to its feed when files change: retract what a file held, load it again.

Typed lines are kept per source file, with the file's checksum noted in the version that
brought them in. A run parses only files that are new or whose content changed, drops the lines
of files that are gone, and curates again only the months in which those files had or have
lines. A duplicate that lost against a retracted line comes back that way, too.

Two versioned tables, each bringing the next up to date: a run cut short between them is
finished by the next one.

Disk: lines are typed without a shuffle, and months are curated a few at a time (a large one by parts of
its keys), whose shuffles are gone before the next begin. They grow with the cores, not with the feed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark import constants as K
from tillspark.operators.dedup import first_per_key
from tillspark.plans.curate import derived_sales, is_usable, typed_sales
from tillspark.schemas import CORRUPT_RECORD
from tillspark.session import DROP_SHUFFLES, SMALL_READS, settings
from tillspark.sinks.versions import Change, Version, VersionedTable, partition_of
from tillspark.sources.feeds import header_checked, sales_reader
from tillspark.sources.files import file_checksums

FILE = "source_file"
# of a file's path: a folder name that needs no escapes
FILE_ID = "source_id"
# lines that are curated at a time
LINES_PER_CORE = 1_000_000


def _months(typed: DataFrame) -> DataFrame:
    day = F.col("invoice_date")
    return typed.select(F.year(day).alias(K.SALES_PARTITIONS[0]), F.month(day).alias(K.SALES_PARTITIONS[1]))


def _lines_by_month(typed: DataFrame) -> dict[tuple[int, int], int]:
    return {(year, month): n for year, month, n in _months(typed).groupBy(*K.SALES_PARTITIONS).count().collect()}


def _within(months: Sequence[tuple[int, int]]) -> Column:
    """Lines of these months, as plain ranges, which reach the Parquet reader."""
    spans = F.lit(False)
    for year, month in months:
        start = F.make_timestamp(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        spans |= (F.col("invoice_date") >= start) & (F.col("invoice_date") < F.add_months(start, 1).cast("timestamp"))
    return spans


def _batches(lines: dict[tuple[int, int], int], most: int) -> Iterator[tuple[list[tuple[int, int]], Column]]:
    """The months in order, as many at a time as have ``most`` lines together, and a part of their keys.

    A month of more lines comes in several parts. There is one batch at least.
    """
    batch: list[tuple[int, int]] = []
    held = 0
    for month in sorted(lines):
        if batch and held + lines[month] > most:
            yield batch, F.lit(True)
            batch, held = [], 0
        batch, held = [*batch, month], held + lines[month]
        if held > most:
            parts = -(-held // most)
            for part in range(parts):
                yield batch, F.pmod(F.xxhash64(*K.SALES_KEY), F.lit(parts)) == part
            batch, held = [], 0
    if batch or not lines:
        yield batch, F.lit(True)


def _typed_files(spark: SparkSession, paths: Sequence[str], multi_line: bool) -> DataFrame:
    """Typed lines of the given files with their file; malformed ones keep their text."""
    parsed = sales_reader(spark.read, multi_line).csv(list(paths))
    named = parsed.withColumns({FILE: F.col("_metadata.file_path"), "_raw_date": F.col("InvoiceDate")})
    typed = typed_sales(named, carry=("_raw_date", CORRUPT_RECORD, FILE))
    return typed.withColumn(FILE_ID, F.md5(FILE))


def reload_files(spark: SparkSession, feed: str, typed: str, multi_line: bool = False) -> dict[str, list[str]]:
    """Bring the typed lines up to the feed's files; returns what was loaded and what was dropped."""
    table = VersionedTable(spark, typed, [FILE_ID])
    # one short text per file, of files that the driver lists anyway
    now = {r["path"]: (r["checksum"], r["id"]) for r in file_checksums(spark, feed).withColumn("id", F.md5("path")).collect()}
    done: dict[str, list[str]] = {}

    def change(base: Version) -> Change | None:
        known = base.notes.get("files", {})
        load = sorted(path for path, state in now.items() if known.get(path) != list(state))
        drop = sorted(path for path in known if path not in now)
        done.update(loaded=load, dropped=drop)
        if not load and not drop:
            return None
        folders, schema = [], base.schema
        if load:
            rows = _typed_files(spark, load, multi_line)
            # a task sorts what it reads
            with header_checked(feed), settings(spark, SMALL_READS):
                folders, _ = table.write(rows, cluster=["invoice_date"], spread=False, compression="zstd")
            schema = rows.schema
        gone = {f"{FILE_ID}={known[path][1]}" for path in (*load, *drop) if path in known}
        return Change(folders, base.in_partitions(gone), schema, {"files": {p: list(s) for p, s in now.items()}})

    table.update(change)
    return done


def refresh_lake(spark: SparkSession, typed: str, lake: str, source_system: str = "RETAIL_FEED") -> list[str]:
    """Curate again the months in which the typed lines changed; returns their partitions."""
    source = VersionedTable(spark, typed, [FILE_ID])
    target = VersionedTable(spark, lake, K.SALES_PARTITIONS)
    refreshed: list[str] = []

    def change(base: Version) -> Change | None:
        known, newest = base.notes.get("typed_version", 0), source.version()
        steps = [source.version(n) for n in range(known + 1, newest.number + 1)]
        changed = sorted({f for step in steps for f in (*step.added, *step.removed)})
        if not changed:
            return None

        usable = F.col(CORRUPT_RECORD).isNull() & is_usable()
        stored = source.read(newest).where(usable)
        months = sorted(_lines_by_month(source.read(newest, changed).where(usable)))
        refreshed[:] = sorted(f"{K.SALES_PARTITIONS[0]}={year}/{K.SALES_PARTITIONS[1]}={month}" for year, month in months)
        now = _lines_by_month(stored.where(_within(months)))
        # one time for all batches
        stamp = F.timestamp_micros(F.lit(spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]))
        folders: list[str] = []
        most = LINES_PER_CORE * spark.sparkContext.defaultParallelism
        for batch, keys in _batches({m: now.get(m, 0) for m in months}, most):
            lines = stored.where(_within(batch) & keys).drop("_raw_date", CORRUPT_RECORD, FILE, FILE_ID)
            # what is derived follows from the key and the columns that come first in the order of duplicates
            curated = derived_sales(first_per_key(lines, K.SALES_KEY), source_system, stamp)
            folders += target.write(curated)[0]
        touched = set(refreshed) | {partition_of(f) for f in folders}
        return Change(folders, base.in_partitions(touched), curated.schema, {"typed_version": newest.number})

    target.update(change)
    return refreshed


def reload_feed(
    spark: SparkSession, feed: str, typed: str, lake: str, source_system: str = "RETAIL_FEED", multi_line: bool = False
) -> dict[str, list[str]]:
    """Make the lake what a full curation of the feed would make it, from the files that changed.

    The folders of replaced versions stay until ``vacuum``, which must not run before the lake
    has seen them.
    """
    with settings(spark, DROP_SHUFFLES):
        done = reload_files(spark, feed, typed, multi_line)
        return {**done, "months": refresh_lake(spark, typed, lake, source_system)}
