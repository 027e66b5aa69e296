import time
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from tillspark.operators.quality import QualityGateError
from tillspark.plans import curate as C
from tillspark.plans.job import arguments, run
from tillspark.plans import job, reload
from tillspark.plans.warehouse import load_warehouse, read_table
from tillspark.sources.lake import read_lake
from tillspark.schemas import FACT_SALES_COLUMNS, RAW_SALES
from tillspark.session import shared_folder
from tillspark.sinks.lake import WriteError, verify_lake, write_lake
from tillspark.sources.feeds import read_raw_sales, sales_reader
from tillspark.sources.files import SourceError

ROWS = [
    ("A-100", "mug1", "Blue mug", 4, "2019-03-07 16:05:00", Decimal("7.35"), "412.0", "Norway"),
    ("C-101", "bowl", "Cracked bowl", -3, "2019-03-08 10:00:00", Decimal("12.10"), "388", "Chile"),
    ("A-102", "tray", None, 9, "2020-11-30 23:59:59", Decimal("0.95"), " ", " "),
    ("A-103", "MUG1", "Blue mug", -1, "2020-12-01 00:00:00", Decimal("7.35"), "412", "Norway"),
]


def test_derivations(spark):
    curated = C.curate(spark.createDataFrame(ROWS, RAW_SALES))
    assert curated.columns == FACT_SALES_COLUMNS
    found = {
        r.invoice_no: (r.stock_code, r.description, r.customer_id, r.country, r.gross_amount, r.is_cancellation,
                       r.transaction_year, r.transaction_month)
        for r in curated.collect()
    }
    assert found == {
        "A-100": ("MUG1", "Blue mug", 412, "Norway", Decimal("29.40"), 0, 2019, 3),
        "C-101": ("BOWL", "Cracked bowl", 388, "Chile", Decimal("-36.30"), 1, 2019, 3),
        "A-102": ("TRAY", "UNKNOWN DESCRIPTION", None, "Unknown", Decimal("8.55"), 0, 2020, 11),
        "A-103": ("MUG1", "Blue mug", 412, "Norway", Decimal("-7.35"), 1, 2020, 12),
    }


def test_duplicates_are_removed_and_counted(spark):
    raw = spark.createDataFrame([ROWS[0], ROWS[0], ROWS[1]], RAW_SALES)
    assert C.curate(raw).count() == 2
    assert C.curation_counters(raw).first().duplicates_removed == 1


def test_survivor_does_not_depend_on_order(spark):
    other = ROWS[0][:2] + ("A blue mug",) + ROWS[0][3:]
    names = {
        C.curate(spark.createDataFrame(rows, RAW_SALES)).first().description
        for rows in ([ROWS[0], other], [other, ROWS[0]])
    }
    assert names == {"A blue mug"}


def test_blank_invoice_passes_null_invoice_and_bad_date_do_not(spark):
    raw = spark.createDataFrame(
        [
            ("", *ROWS[0][1:]),
            (None, *ROWS[0][1:]),
            (*ROWS[0][:4], "junk", *ROWS[0][5:]),
            (*ROWS[0][:4], None, *ROWS[0][5:]),
        ],
        RAW_SALES,
    )
    assert [r.invoice_no for r in C.curate(raw).collect()] == [""]
    reasons = sorted(r.reject_reason for r in C.rejected_sales(raw).collect())
    assert reasons == ["missing invoice number", "unreadable invoice date", "unreadable invoice date"]
    counters = C.curation_counters(raw).first()
    assert (counters.initial_raw_records, counters.rejected_records, counters.final_curated_records) == (4, 3, 1)


HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
FEED = HEADER + (
    "1,a1,plain,6,2010-12-01 08:26:00,2.555,17850.0,United Kingdom\n"
    "2,a2,float quantity,6.0,2010-12-01 08:26:00,1.00,17850.0,United Kingdom\n"
    "3,a3,bad quantity,zz,2010-12-01 08:26:00,1.00,17850.0,United Kingdom\n"
    "4,a4,tiny price,1,12/1/2010 8:26,0.001,17850.0,United Kingdom\n"
    '5,a5,"q, ""z""",1,2010-12-01,1.00,17850.0,United Kingdom\n'
    '6,a6,"two\nlines",1,2010-12-01,1.00,17850.0,United Kingdom\n'
    "7,a7,short row\n"
    "8,a8,guest,1,01/02/2011 09:00,1.00,,France\n"
    "9,a9,day first,1,13/02/2011 09:00,1.00,,France\n"
    "10,b1,unreadable,1,junk,1.00,,France\n"
    "11,b2,no date,1,,1.00,,France\n"
)


@pytest.fixture
def feed(tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "lines.csv").write_text(FEED)
    return str(tmp_path / "feed")


def test_malformed_lines_are_kept_apart(spark, feed):
    raw = read_raw_sales(spark, feed, multi_line=True)
    assert raw.lines.count() == 8 and raw.malformed.count() == 3
    assert sorted(r.raw_text.split(",")[0] for r in raw.malformed.collect()) == ["2", "3", "7"]
    lines = {r.InvoiceNo: r for r in raw.lines.collect()}
    assert lines["1"].UnitPrice == Decimal("2.56") and lines["4"].UnitPrice == Decimal("0.00")
    assert lines["5"].Description == 'q, "z"' and lines["6"].Description == "two\nlines"
    # counts do not depend on which columns are read
    assert raw.lines.select("Country").count() == len(raw.lines.collect())


def test_dates_of_a_feed(spark, feed):
    raw = read_raw_sales(spark, feed, multi_line=True)
    days = {r.invoice_no: r.invoice_date for r in C.curate(raw.lines).collect()}
    assert days["8"] == datetime(2011, 1, 2, 9) and days["9"] == datetime(2011, 2, 13, 9)
    assert "10" not in days and "11" not in days


def test_missing_and_empty_feeds_fail(spark, tmp_path):
    with pytest.raises(SourceError):
        read_raw_sales(spark, str(tmp_path / "absent"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(SourceError):
        read_raw_sales(spark, str(tmp_path / "empty.csv"))


def test_lake_round_trip(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = write_lake(C.curate(spark.createDataFrame(ROWS, RAW_SALES)), path)
    assert rows == 4
    check = verify_lake(spark, path, rows).first()
    assert check.status == "PASSED" and check.partition_values == [2019, 2020]
    assert len(list((tmp_path / "lake").glob("commit=*/transaction_year=2020/transaction_month=12"))) == 1
    with pytest.raises(WriteError):
        verify_lake(spark, path, rows + 1)


def _args(tmp_path, feed, *extra):
    folders = [f"--{n}={tmp_path}/{n}" for n in ("lake", "warehouse", "reports")]
    return arguments([f"--raw={feed}", *folders, "--multi-line", *extra])


def test_job_is_repeatable(spark, tmp_path, feed):
    first = run(spark, _args(tmp_path, feed))
    assert first["initial_raw_records"] == 11 and first["malformed_records"] == 3
    assert first["rejected_records"] == 2 and first["final_curated_records"] == 6
    assert first["fact_rows_inserted"] == first["fact_sales_count"] == 6
    again = run(spark, _args(tmp_path, feed, "--skip-curation"))
    assert again["fact_rows_inserted"] == 0
    assert {k: v for k, v in again.items() if k.endswith("_count")} == {
        k: v for k, v in first.items() if k.endswith("_count")
    }
    log = spark.read.parquet(f"{tmp_path}/warehouse/etl_pipeline_logs")
    assert [r.status for r in log.collect()] == ["COMPLETED", "COMPLETED"]
    assert spark.read.json(f"{tmp_path}/reports/malformed").count() == 3


def test_job_failure_is_logged(spark, tmp_path, feed):
    with pytest.raises(SourceError):
        run(spark, _args(tmp_path, feed, "--min-bytes=1000000"))
    log = spark.read.parquet(f"{tmp_path}/warehouse/etl_pipeline_logs").first()
    assert log.status == "FAILED" and "expected at least" in log.error_message


def test_row_floor_counts_every_line(spark, tmp_path, feed):
    run(spark, _args(tmp_path, feed, "--skip-load", "--min-rows=11"))
    report = spark.read.json(f"{tmp_path}/reports/raw_validation").first()
    assert (report.total_records, report.malformed_records, report.status) == (11, 3, "PASSED")
    nulls = {c.column_name: (c.null_count, c.null_pct) for c in report.columns}
    assert nulls["CustomerID"] == (4, 36.36) and nulls["InvoiceNo"] == (0, 0.0)
    with pytest.raises(QualityGateError):
        run(spark, _args(tmp_path, feed, "--skip-load", "--min-rows=12"))


@pytest.mark.parametrize(
    "header",
    [
        "InvoiceNo,Description,StockCode,Quantity,InvoiceDate,UnitPrice,CustomerID,Country",
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Nation",
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID",
    ],
)
@pytest.mark.parametrize("multi_line", [False, True])
def test_other_headers_are_refused_in_every_file(spark, tmp_path, feed, header, multi_line):
    row = ",".join("1" for _ in header.split(","))
    (tmp_path / "feed" / "more.csv").write_text(f"{header}\n{row}\n")
    with pytest.raises(SourceError, match="other columns"):
        read_raw_sales(spark, feed, multi_line)
    with pytest.raises(SourceError, match="other columns"):
        run(spark, _args(tmp_path, feed, "--skip-load"))


def test_feed_is_parsed_once(spark, feed):
    parsed = sales_reader(spark.read, True).csv(feed)
    typed = C.typed_feed(parsed)
    assert typed.counts["total"] == 11 and typed.counts["malformed"] == 3 and typed.counts["rejected"] == 2
    stamp = F.lit("2020-01-01").cast("timestamp")
    for df in (typed.curated("T", stamp), typed.rejected(), typed.malformed()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan csv" not in plan and "parquet" in plan
    assert typed.curated("T", stamp).count() == 6 and typed.rejected().count() == 2


def test_loads_with_blank_key_fields_are_repeatable(spark, tmp_path):
    raw = [
        ("1", None, "no code", 2, "2024-01-05", Decimal("3.00"), "7", "X"),
        ("2", "a", "no quantity", None, "2024-01-05", Decimal("3.00"), "7", "X"),
        ("3", "b", "whole", 1, "2024-01-05", Decimal("3.00"), None, "X"),
    ]
    house = str(tmp_path / "house")
    seen = []
    for _ in range(3):
        write_lake(C.curate(spark.createDataFrame(raw, RAW_SALES)), str(tmp_path / "lake"))
        load_warehouse(spark, str(tmp_path / "lake"), house)
        seen.append([read_table(spark, house, t).count() for t in ("fact_sales", "dim_products", "dim_customers")])
    assert seen == [[3, 3, 1]] * 3


def test_a_run_goes_on_after_a_finished_curation(spark, tmp_path, feed, monkeypatch):
    def killed(*args):
        raise KeyboardInterrupt

    real = job.load_warehouse
    monkeypatch.setattr(job, "load_warehouse", killed)
    with pytest.raises(KeyboardInterrupt):
        run(spark, _args(tmp_path, feed))
    monkeypatch.setattr(job, "load_warehouse", real)
    monkeypatch.setattr(job, "curate_to_lake", killed)
    resumed = run(spark, _args(tmp_path, feed, "--resume"))
    assert resumed["final_curated_records"] == resumed["fact_rows_inserted"] == 6
    # another feed, other options or another lake: curated again
    with pytest.raises(KeyboardInterrupt):
        run(spark, _args(tmp_path, feed, "--resume", "--source-system=OTHER"))
    write_lake(C.curate(spark.createDataFrame(ROWS, RAW_SALES)), f"{tmp_path}/lake")
    with pytest.raises(KeyboardInterrupt):
        run(spark, _args(tmp_path, feed, "--resume"))


LINES = {
    "a.csv": ["1,a,x,1,2024-01-01,2.00,7,FR", "2,a,x,1,2024-02-01,2.00,,FR", "bad row", "9,a,x,1,junk,2.00,,FR"],
    "b.csv": ["1,a,other,1,2024-01-01,1.00,7,FR", "3,a,x,1,2024-03-01,2.00,,FR"],
    "c.csv": ["4,a,x,1,2024-04-01,2.00,,FR"],
}


def test_a_changed_file_is_retracted_and_loaded_again(spark, tmp_path):
    folder, typed, lake = tmp_path / "feed", str(tmp_path / "typed"), str(tmp_path / "lake")
    folder.mkdir()

    def deliver(files):
        header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        for name, lines in files.items():
            (folder / name).write_text(header + "\n".join(lines) + "\n")

    def settled():
        done = reload.reload_feed(spark, str(folder), typed, lake)
        whole = C.curate(read_raw_sales(spark, str(folder)).lines).drop("ingestion_timestamp")
        kept = read_lake(spark, lake).select(*whole.columns)
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        return [len(done["loaded"]), len(done["dropped"]), [m[-1] for m in done["months"]]]

    deliver(LINES)
    assert settled() == [3, 0, ["1", "2", "3", "4"]]
    assert settled() == [0, 0, []]
    # the winner of a duplicate goes: the other file's line comes back
    deliver({"b.csv": ["3,a,x,5,2024-03-02,2.00,,FR", "3,b,x,5,2024-05-02,2.00,,FR"]})
    assert settled() == [1, 0, ["1", "3", "5"]]
    (folder / "c.csv").unlink()
    assert settled() == [0, 1, ["4"]]
    deliver({"a.csv": [], "d.csv": LINES["c.csv"]})
    assert settled() == [2, 0, ["1", "2", "4"]]


def test_a_reload_cut_short_is_finished(spark, tmp_path):
    folder, typed, lake = tmp_path / "feed", str(tmp_path / "typed"), str(tmp_path / "lake")
    folder.mkdir()
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    (folder / "a.csv").write_text(header + "1,a,x,1,2024-01-01,2.00,7,FR\n")
    reload.reload_feed(spark, str(folder), typed, lake)
    (folder / "a.csv").write_text(header + "1,a,x,1,2024-02-01,2.00,7,FR\n")
    reload.reload_files(spark, str(folder), typed)  # and no further
    assert reload.reload_feed(spark, str(folder), typed, lake)["loaded"] == []
    assert [r.transaction_month for r in read_lake(spark, lake).collect()] == [2]


def test_a_region_of_the_registered_feed_is_written_by_several_tasks(spark, monkeypatch):
    from registry import load_queries as L

    class Stop(Exception):
        pass

    def stop(spark, feed, *rest):
        raise Stop(feed)

    monkeypatch.setattr(L.reload, "reload_feed", stop)
    monkeypatch.setattr(L.S, "sales_feed", lambda *a, feed=L.S.sales_feed: feed(*a).repartition(8))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2KB")
    try:
        with pytest.raises(Stop) as stopped:
            L._reloaded(spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.unset(size)
    files = spark.read.format("binaryFile").load(f"{stopped.value}/*.csv").select("path").collect()
    regions = [r[0].split("n_regionkey=")[1][0] for r in files]
    assert all(regions.count(region) > 1 for region in "01234")


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in found.mkString("\n").split("\n") if "/shuffle_" in name}


def _deliver(folder, **files):
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    for name, lines in files.items():
        (folder / f"{name}.csv").write_text(header + "\n".join(lines) + "\n")


def test_a_reload_leaves_no_shuffle_files(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    _deliver(tmp_path / "feed", a=[f"{n},a,x,1,2024-0{n % 3 + 1}-01,2.00,7,FR" for n in range(30)])
    before = _shuffle_files(spark)
    reload.reload_feed(spark, *[str(tmp_path / name) for name in ("feed", "typed", "lake")])
    until = time.time() + 20  # they are deleted in the background
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_months_are_curated_a_few_at_a_time(spark, tmp_path, monkeypatch):
    folder, typed, lake = tmp_path / "feed", str(tmp_path / "typed"), str(tmp_path / "lake")
    folder.mkdir()
    written = []
    write = reload.VersionedTable.write

    def counted(table, df, *args, **options):
        folders, rows = write(table, df, *args, **options)
        written.append((table.path, rows, options.get("spread", True)))
        return folders, rows

    monkeypatch.setattr(reload.VersionedTable, "write", counted)
    monkeypatch.setattr(reload, "LINES_PER_CORE", 1, raising=False)
    most = spark.sparkContext.defaultParallelism

    def settled(months):
        written.clear()
        assert len(reload.reload_feed(spark, str(folder), typed, lake)["months"]) == months
        whole = C.curate(read_raw_sales(spark, str(folder)).lines).drop("ingestion_timestamp")
        kept = read_lake(spark, lake)
        assert sorted(map(tuple, kept.select(*whole.columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        assert all(not spread for path, _, spread in written if path == typed)
        return [rows for path, rows, _ in written if path == lake]

    # all months fit; none does, with every line four times in two files; one does not
    twice = [f"{n},a,x,1,2024-0{m}-0{n % 9 + 1},{p}.00,,FR" for m in (1, 2, 3) for n in range(most) for p in (2, 3)]
    _deliver(folder, a=[f"0,a,x,1,2024-0{m}-01,2.00,,FR" for m in (1, 2, 3)])
    assert settled(3) == [3]
    _deliver(folder, a=twice, b=[line.replace(",x,", ",w,") for line in twice])
    rows = settled(3)
    assert len(rows) > 6 and sum(rows) == 3 * most
    assert read_lake(spark, lake).select("ingestion_timestamp").distinct().count() == 1
    _deliver(folder, a=twice[: 2 * most], b=["1,a,x,1,2024-02-01,2.00,,FR"])
    rows = settled(3)
    assert len(rows) == 3 and sum(rows) == most + 1
    _deliver(folder, a=[], b=[])
    assert settled(2) == [0]


def test_a_large_registered_feed_is_compressed_and_what_was_staged_is_deleted(spark, monkeypatch):
    from registry import load_queries as L

    shared = Path(shared_folder(spark))
    before, feeds, load = set(shared.iterdir()), [], reload.reload_feed

    def seen(spark, feed, typed, lake, source):
        files = list(Path(lake).parent.glob("feed/*/part-*"))
        regions = [f.parent.name for f in files]
        feeds.append(({f.suffix for f in files}, set(regions), Path(lake).parent))
        return load(spark, feed, typed, lake, source)

    monkeypatch.setattr(L.reload, "reload_feed", seen)
    plain = L._reloaded(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(L, "LARGE_FEED", 0, raising=False)
    large = L._reloaded(spark, "/root/testdata/sf0.001")
    regions = {f"n_regionkey={r}" for r in range(5)}
    assert [f[:2] for f in feeds] == [({".csv"}, regions)] * 2 + [({".gz"}, regions)] * 2
    assert sorted(map(str, plain.collect())) == sorted(map(str, large.collect())) and plain.count()
    assert set(shared.iterdir()) - before == {f[2] for f in feeds}
    assert all([p.name for p in f[2].iterdir()] == ["lake"] for f in feeds)
