import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.plans.health import pipeline_health
from tillspark.plans.warehouse import create_lake_dimensions, read_table
from tillspark.session import shared_folder, staged, staging
from tillspark.sinks import lake as L
from tillspark.sinks import reports as R
from tillspark.sources import feeds, files, jdbc
from tillspark.sources import lake as S
from tillspark.streaming.incremental import load_stream, stream_raw_sales

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def days(spark, *rows):
    return spark.createDataFrame(rows, "n int, order_date string")


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    L.write_partitions(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), path)
    result = L.write_partitions(days(spark, (3, "2024-01-02"), (4, "2024-01-02")), path)
    assert result == {"target_path": path, "expected_records": 2, "verified_records": 2, "status": "SUCCESS"}
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3, 4]
    assert L.write_partitions(days(spark, (5, "2024-01-02")), path, mode="append")["verified_records"] == 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_read_partition(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "n int, order_date date"
    assert S.read_partition(spark, path, schema).count() == 0
    L.write_partitions(days(spark, (1, "2024-01-01"), (2, "2024-01-02")), path)
    assert [r.n for r in S.read_partition(spark, path, schema, "2024-01-02").collect()] == [2]
    assert S.read_partition(spark, path, schema, "2024-02-02").count() == 0
    assert S.read_partition(spark, path, schema).count() == 2


def test_lake_scan_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(20).select(
        F.col("id").alias("a"), F.lit("x").alias("b"), (F.col("id") % 4 + 2010).cast("int").alias("transaction_year")
    ).write.partitionBy("transaction_year").parquet(path)
    df = S.read_lake(spark, path, ["a"], (F.col("transaction_year") == 2011) & (F.col("a") > 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:bigint>" in plan and "GreaterThan(a,3)" in plan
    assert "PartitionFilters: [isnotnull(transaction_year" in plan
    assert sorted(r.a for r in df.collect()) == [5, 9, 13, 17]
    S.register_lake(spark, path, "lake_view")
    assert spark.sql("select count(*) from lake_view").first()[0] == 20


def test_busy_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "100KB")
    try:
        df = spark.range(0, 200000, 1, 8).select(F.rand(1).alias("v"), F.lit(1).alias("month"))
        L._counting_writer(df, ["month"])[0].parquet(path)
    finally:
        spark.conf.set(conf, before)
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{path}/month=1")) > 1
    assert spark.read.parquet(path).count() == 200000


def test_staging_uses_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert staged(spark.range(5), "x").count() == 5


def test_text_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Order ID,note\n007,\n8,"say ""hi"""\n')
    rows = feeds.read_text_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [tuple(r)[:4] for r in rows] == [
        ("007", "", "a.csv", "CSV_SALES"),
        ("8", 'say "hi"', "a.csv", "CSV_SALES"),
    ]


def test_declared_master_schemas(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "product_id,product_name,category,brand,price,stock,source_system,ingestion_timestamp\nP,M,C,B,2.5,3,S,T\n"
    )
    (tmp_path / "c.csv").write_text(
        "customer_id,customer_name,city,state,country,source_system,ingestion_timestamp\nC,N,X,,IT,S,T\n"
    )
    assert feeds.read_catalog(spark, str(tmp_path / "p.csv")).first().price == 2.5
    assert feeds.read_customers(spark, str(tmp_path / "c.csv")).first().country == "IT"


def test_latest_file(spark, tmp_path):
    assert files.latest_file(spark, str(tmp_path)) is None
    for i, name in enumerate(["old.csv", "new.csv", "other.txt"]):
        (tmp_path / name).write_text("a\n1\n")
        os.utime(tmp_path / name, (1_700_000_000 + i, 1_700_000_000 + i))
    assert files.latest_file(spark, str(tmp_path)).endswith("new.csv")


def test_null_partition_values_are_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        rows = days(spark, (n, "2024-01-01"), (n, None), (n, None))
        assert L.write_partitions(rows, path)["verified_records"] == 3
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [2, 2, 2]


def test_staged_tables_go_with_their_scope(spark):
    with staging(spark):
        kept = staged(spark.range(5), "scoped").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(kept)
    assert not os.path.exists(kept)


def test_only_a_local_session_gets_a_folder_of_its_own(monkeypatch):
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master, applicationId = "local-cluster[2,1,1024]", "x"

    with pytest.raises(RuntimeError):
        shared_folder(Session)
    Session.sparkContext.master = "local[2]"
    assert shared_folder(Session)


def test_manifest_and_reconciliation(spark, tmp_path):
    import hashlib

    folder = tmp_path / "feed"
    folder.mkdir()
    body = 'a,"b,c"\n1,2\n3,"4\n5"\n'
    (folder / "x.csv").write_text(body)
    (folder / "y.csv").write_text("d\n5\n")
    manifest = files.source_manifest(spark, str(folder), multi_line=True, sha256=True)
    rows = {os.path.basename(r.path): r for r in manifest.collect()}
    assert rows["x.csv"].sha256 == hashlib.sha256(body.encode()).hexdigest()
    assert (rows["x.csv"].record_count, rows["x.csv"].file_bytes, rows["x.csv"].columns) == (2, len(body), ["a", "b,c"])
    assert (rows["y.csv"].columns, rows["y.csv"].column_count) == (["d"], 1)
    manifest.coalesce(1).write.json(str(tmp_path / "manifest"))
    expected = spark.read.json(str(tmp_path / "manifest"))
    assert files.manifest_mismatches(expected, manifest).count() == 0
    (folder / "y.csv").write_text("d\n6\n")
    again = files.source_manifest(spark, str(folder), multi_line=True, sha256=True)
    changed = files.manifest_mismatches(expected, again).collect()
    assert {r.attribute for r in changed} == {"sha256", "line_checksum"}


def test_equal_lines_do_not_cancel_in_the_checksum(spark, tmp_path):
    (tmp_path / "x.csv").write_text("h\nx\nx\n")
    (tmp_path / "y.csv").write_text("h\ny\ny\n")
    sums = {r.line_checksum for r in files.source_manifest(spark, str(tmp_path)).collect()}
    assert len(sums) == 2


def test_document_without_paths_is_reconciled_with_totals(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "x.csv").write_text("a,b\n1,2\n")
    document = {"record_count": 1, "columns": ["a", "b"], "csv_file_bytes": 8, "sha256_csv": "0"}
    (tmp_path / "m.json").write_text(json.dumps(document, indent=1))
    actual = files.source_manifest(spark, str(tmp_path / "feed"), sha256=True)
    found = files.manifest_mismatches(files.read_manifest(spark, str(tmp_path / "m.json")), actual)
    assert [r.attribute for r in found.collect()] == ["sha256"]


def test_reports_quarantine_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'c"d')], "n int, t string")
    R.write_report(df.limit(1), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().execution_timestamp
    for _ in range(2):
        R.write_quarantine(df, str(tmp_path / "q"), "b1")
    R.write_quarantine(df, str(tmp_path / "q"), "b2")
    assert spark.read.json(str(tmp_path / "q")).groupBy("batch_id").count().count() == 2
    assert spark.read.json(str(tmp_path / "q")).count() == 4
    R.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert sorted(r.t for r in back.collect()) == ["a,b", 'c"d']


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert R.read_runs(spark, path).count() == 0
    start = datetime(2024, 1, 1)
    R.log_run(spark, path, "r1", "p", start, None, "RUNNING")
    R.log_run(spark, path, "r1", "p", start, datetime(2024, 1, 1, 0, 1, 30), "COMPLETED", 5, metrics={"a": 1})
    R.log_run(spark, path, "r2", "p", datetime(2024, 1, 2), None, "FAILED", error_message="no")
    health = pipeline_health(R.read_runs(spark, path)).collect()
    assert [(r.run_id, r.status, r.duration_seconds) for r in health] == [
        ("r2", "FAILED", None),
        ("r1", "COMPLETED", 90),
    ]
    assert R.log_run(spark, "no-such-scheme://x", "r", "p", start, None, "X") is False


def test_jdbc_reads_are_split():
    with pytest.raises(TypeError):
        jdbc.jdbc_options("jdbc:x", "customers")
    split = jdbc.jdbc_options("jdbc:x", "t", column="id", bounds=(1, 100), partitions=4, user="u")
    assert split["numPartitions"] == "4" and split["upperBound"] == "100" and split["user"] == "u"


def test_the_record_written_last_is_the_state(spark, tmp_path):
    path, start = str(tmp_path / "log"), datetime(2024, 1, 1)
    R.log_run(spark, path, "r", "p", start, None, "RUNNING", 100)
    R.log_run(spark, path, "r", "p", start, None, "FAILED", 0)
    assert [r.status for r in R.read_runs(spark, path).collect()] == ["FAILED"]


def test_lake_dimensions_are_views(spark, tmp_path):
    facts = spark.createDataFrame(
        [("1", "a", "d", 2, datetime(2020, 1, 1), "2.00", 7, "X", "4.00", 0)],
        "invoice_no string, stock_code string, description string, quantity int, invoice_date timestamp,"
        " unit_price string, customer_id int, country string, gross_amount string, is_cancellation int",
    ).withColumns({"unit_price": F.col("unit_price").cast("decimal(10,2)"),
                   "gross_amount": F.col("gross_amount").cast("decimal(12,2)")})
    create_lake_dimensions(spark, facts, str(tmp_path))
    assert spark.sql("select total_units_sold from dim_products").first()[0] == 2
    assert spark.sql("select total_orders from dim_customers").first()[0] == 1


def test_incremental_load(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    os.makedirs(shared, exist_ok=True)
    before = set(os.listdir(shared))
    feed, house, checkpoint = (str(tmp_path / n) for n in ("feed", "house", "checkpoint"))
    os.mkdir(feed)

    def deliver(name, *lines):
        with open(f"{feed}/{name}", "w") as out:
            out.write(HEADER + "\n".join(lines) + "\n")

    def load():
        load_stream(stream_raw_sales(spark, feed, files_per_batch=1), house, checkpoint).awaitTermination()
        return read_table(spark, house, "fact_sales").count()

    deliver("1.csv", "1,a,x,1,2024-01-01,2.00,7,FR", "bad row")
    deliver("2.csv", "1,a,x,1,2024-01-01,2.00,7,FR", "2,a,x,1,2024-02-01,2.00,,FR", "9,a,x,1,junk,2.00,,FR")
    assert load() == 2
    assert load() == 2
    deliver("3.csv", "2,a,x,1,2024-02-01,2.00,,FR", "3,a,x,1,2024-02-01,2.00,,FR")
    assert load() == 3
    assert spark.read.json(f"{house}/malformed_lines").count() == 1
    rejected = spark.read.json(f"{house}/rejected_lines").collect()
    assert [(r.invoice_no, r.raw_invoice_date, r.reject_reason) for r in rejected] == [
        ("9", "junk", "unreadable invoice date")
    ]
    assert set(os.listdir(shared)) == before  # nothing staged is left behind
