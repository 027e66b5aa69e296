"""The whole batch job: validate, curate, load, log.

    spark-submit sales_job.py --raw ... --lake ... --warehouse ... --reports ...
"""

from __future__ import annotations

import argparse
import hashlib
import sys
from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from tillspark.operators.quality import QualityGateError
from tillspark.operators.rollups import curation_metrics
from tillspark.plans.curate import TypedFeed, typed_feed
from tillspark.plans.warehouse import load_warehouse
from tillspark.schemas import RAW_SALES_COLUMNS
from tillspark.session import build_session, staging
from tillspark.sinks.lake import verify_lake, write_lake
from tillspark.sinks.reports import log_run, write_quarantine, write_report
from tillspark.sinks.versions import Change, Version, VersionedTable
from tillspark.sources.feeds import header_checked, sales_reader
from tillspark.sources.files import list_files, require_content
from tillspark.sources.lake import read_lake

PIPELINE = "sales_pipeline"


def raw_report(path: str, size: int, counts: dict[str, int]) -> Row:
    """File size, line count and null profile of a feed; counts include malformed lines."""
    total = counts["total"]
    columns = [
        Row(column_name=c, null_count=counts[f"null_{c}"], null_pct=round(100 * counts[f"null_{c}"] / total, 2) if total else 0.0)
        for c in RAW_SALES_COLUMNS
    ]
    return Row(
        file_path=path, file_size_bytes=size, file_size_mb=round(size / 2**20, 2), total_records=total,
        malformed_records=counts["malformed"], columns=columns, status="PASSED",
    )


def read_feed(
    spark: SparkSession, path: str, multi_line: bool, min_bytes: int, min_rows: int
) -> tuple[TypedFeed, Row]:
    """Parse and type the feed once. Raises on other headers than declared or below a floor."""
    size = require_content(spark, path, min_bytes)
    with header_checked(path):
        feed = typed_feed(sales_reader(spark.read, multi_line).csv(path))
    if feed.counts["total"] < min_rows:
        raise QualityGateError(f"{path} holds {feed.counts['total']} rows, expected at least {min_rows}")
    return feed, raw_report(path, size, feed.counts)


def curate_to_lake(
    spark: SparkSession, feed: TypedFeed, lake: str, reports: str, run_id: str, source_system: str
) -> dict[str, int]:
    """Curate, write, read back, and report counts and metrics.

    All come from the typed table; row counts are taken while writing.
    """
    stamp = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    rows = write_lake(feed.curated(source_system, stamp), lake)
    verified = verify_lake(spark, lake, rows)
    total, malformed, rejected = (feed.counts[c] for c in ("total", "malformed", "rejected"))
    counters = {
        "initial_raw_records": total,
        "malformed_records": malformed,
        "rejected_records": rejected,
        "duplicates_removed": total - malformed - rejected - rows,
        "final_curated_records": rows,
    }
    write_quarantine(feed.rejected(), f"{reports}/rejected", run_id)
    write_quarantine(feed.malformed(), f"{reports}/malformed", run_id)
    write_report(spark.createDataFrame([Row(**counters)]), f"{reports}/curation_counters")
    write_report(curation_metrics(read_lake(spark, lake), stored=True), f"{reports}/curation_metrics")
    write_report(verified, f"{reports}/lake_check")
    return counters


def _feed_state(spark: SparkSession, args: argparse.Namespace) -> str:
    """What the curation depends on: the feed's files, their sizes and times, and the options."""
    files = sorted(tuple(map(str, row)) for row in list_files(spark, args.raw).collect())
    return hashlib.md5(repr((files, args.multi_line, args.source_system)).encode()).hexdigest()


def _lake_state(version: Version) -> str:
    return hashlib.md5("\n".join(sorted(version.folders)).encode()).hexdigest()


def finished_curation(spark: SparkSession, args: argparse.Namespace) -> dict[str, int] | None:
    """Counters of a curation that finished with the same feed, while its lake is still the newest.

    The ledger is a note in the lake's own versions, written when the reports are complete.
    """
    version = VersionedTable(spark, args.lake).version()
    done = version.notes.get("curation", {})
    same = done.get("lake") == _lake_state(version) and done.get("feed") == _feed_state(spark, args)
    return done["counters"] if same else None


def note_curation(spark: SparkSession, args: argparse.Namespace, feed: str, counters: dict[str, int]) -> None:
    def change(base: Version) -> Change:
        note = {"feed": feed, "lake": _lake_state(base), "counters": counters}
        return Change(notes={"curation": note}, reads=frozenset())

    VersionedTable(spark, args.lake).update(change)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """All stages in order. Logs the run either way and raises on failure.

    With ``--resume`` a curation that an earlier run finished is not made again.
    """
    started = datetime.now(timezone.utc)
    run_id = f"RUN_{started.strftime('%Y%m%d_%H%M%S_%f')}"
    log = f"{args.warehouse}/etl_pipeline_logs"
    counters: dict[str, int] = {}
    try:
        finished = finished_curation(spark, args) if args.resume else None
        if finished is not None:
            counters = finished
        elif not args.skip_curation:
            state = _feed_state(spark, args)
            with staging(spark):
                feed, report = read_feed(spark, args.raw, args.multi_line, args.min_bytes, args.min_rows)
                write_report(spark.createDataFrame([report]), f"{args.reports}/raw_validation")
                counters = curate_to_lake(
                    spark, feed, args.lake, args.reports, run_id, args.source_system
                )
            note_curation(spark, args, state, counters)
        if not args.skip_load:
            counters |= load_warehouse(spark, args.lake, args.warehouse)
    except Exception as error:
        log_run(
            spark, log, run_id, PIPELINE, started, datetime.now(timezone.utc), "FAILED",
            error_message=str(error),
        )
        raise
    rejected = counters.get("rejected_records", 0) + counters.get("malformed_records", 0)
    log_run(
        spark, log, run_id, PIPELINE, started, datetime.now(timezone.utc), "COMPLETED",
        counters.get("fact_sales_count", 0), rejected, metrics=counters,
    )
    return counters


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("raw", "lake", "warehouse", "reports"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--skip-curation", action="store_true")
    parser.add_argument("--skip-load", action="store_true")
    parser.add_argument("--resume", action="store_true", help="go on after stages that finished with the same feed")
    parser.add_argument("--multi-line", action="store_true", help="quoted line breaks: one task per file")
    parser.add_argument("--min-bytes", type=int, default=1, help="refuse a smaller feed")
    parser.add_argument("--min-rows", type=int, default=0, help="refuse a feed of fewer lines")
    parser.add_argument("--source-system", default="RETAIL_FEED")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    spark = build_session("sales-pipeline")
    try:
        for name, value in run(spark, arguments(argv)).items():
            print(f"{name}: {value:,}")
        return 0
    except Exception as error:
        print(f"failed: {error}", file=sys.stderr)
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
