import pytest
from pyspark.sql import functions as F

from tillspark.operators import joins
from tillspark.operators import quality as Q
from tillspark.plans.warehouse import read_table
from tillspark.plans.order_feed import admit, process_order_feed
from tillspark.schemas import RAW_ORDERS

COLUMNS = "order_id string, order_date string, customer_id string, product_id string, quantity string, unit_price string"


def lines(spark, *changes):
    good = dict(order_id="o", order_date="2024-01-02", customer_id="c", product_id="p", quantity="1", unit_price="2.5")
    return spark.createDataFrame([tuple({**good, **c}.values()) for c in changes], COLUMNS)


def reasons(spark, change, **ids):
    found = Q.check_order_lines(lines(spark, change), **ids).quarantined().collect()
    return found[0].quarantine_reason if found else None


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({"quantity": "2.7"}, None),
        ({"quantity": "0.5"}, "Invalid quantity '0.5': must be integer > 0"),
        ({"quantity": "-1"}, "Invalid quantity '-1': must be integer > 0"),
        ({"quantity": "abc"}, "Invalid quantity 'abc': must be integer > 0"),
        ({"quantity": "nan"}, "Invalid quantity 'nan': must be integer > 0"),
        ({"quantity": "inf"}, "Invalid quantity 'inf': must be integer > 0"),
        ({"quantity": None}, "Invalid quantity 'None': must be integer > 0"),
        ({"unit_price": "0"}, None),
        ({"unit_price": "-0.01"}, "Invalid unit price '-0.01': must be float >= 0"),
        ({"unit_price": "nan"}, "Invalid unit price 'nan': must be float >= 0"),
        ({"order_date": "2024/1/2"}, None),
        ({"order_date": "1999-12-31"}, "Unparseable or out-of-bounds order_date '1999-12-31'"),
        ({"order_date": "2101-01-01"}, "Unparseable or out-of-bounds order_date '2101-01-01'"),
        ({"order_date": "02-01-2024"}, "Unparseable or out-of-bounds order_date '02-01-2024'"),
        ({"order_id": " "}, "Missing mandatory field 'order_id'"),
        (
            {"customer_id": None, "quantity": "0"},
            "Missing mandatory field 'customer_id'; Invalid quantity '0': must be integer > 0",
        ),
    ],
)
def test_row_rules(spark, change, reason):
    assert reasons(spark, change) == reason


def test_foreign_keys(spark):
    known = spark.createDataFrame([("c",), ("c",)], "customer_id string")
    assert reasons(spark, {"customer_id": " c "}, customers=known) is None
    assert reasons(spark, {"customer_id": "x"}, customers=known) == "Unknown customer_id 'x'"
    # a NULL id is reported as missing, not as unknown; an empty id list checks nothing
    assert reasons(spark, {"customer_id": None}, customers=known) == "Missing mandatory field 'customer_id'"
    assert reasons(spark, {"customer_id": "x"}, customers=known.limit(0)) is None
    # duplicates in the id list do not multiply rows
    assert Q.check_order_lines(lines(spark, {}), customers=known).valid().count() == 1


def test_valid_rows_keep_the_input_schema(spark):
    df = lines(spark, {}, {"quantity": "0"})
    assert Q.check_order_lines(df).valid().schema == df.schema


def test_report_status_and_gate(spark):
    checked = Q.check_order_lines(lines(spark, {}, {}, {}, {"quantity": "0"}))
    report = checked.report(30.0).first()
    assert (report.total_records, report.rejected_records, float(report.quarantine_pct)) == (4, 1, 25.0)
    assert report.status == "WARNING" and checked.report(20.0).first().status == "FAILED"
    evaluation = {e.rule_name: e for e in report.evaluations}["valid_quantity_positive"]
    assert evaluation.error_message == "Found 1 non-positive or non-numeric quantities"
    Q.enforce_gate(checked.report(30.0), 30.0)
    with pytest.raises(Q.QualityGateError):
        Q.enforce_gate(checked.report(20.0), 20.0)
    empty = Q.check_order_lines(lines(spark, {}).limit(0)).report(5.0).first()
    assert (empty.total_records, empty.status, float(empty.quarantine_pct)) == (0, "PASSED", 0.0)


def test_schema_contract(spark):
    df = lines(spark, {})
    with pytest.raises(Q.QualityGateError):
        Q.check_order_lines(df.drop("quantity"))
    with pytest.raises(Q.QualityGateError):
        Q.require_columns(df, ["order_id"], forbidden=["quantity"])


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    found = {r.column_name: (r.null_count, float(r.null_pct)) for r in Q.null_profile(df).collect()}
    assert found == {"a": (1, 33.33), "b": (2, 66.67)}


AUDIT = "transaction_id string, customer_id string, product_id string, store_id string, quantity int, unit_price double, transaction_date date, net_amount double, customer_name string"


@pytest.mark.parametrize(
    "row, status, failing",
    [
        (("t", "c", "p", "s", 1, 1.0, 1.0, "n"), "PASSED", []),
        (("t", "c", "p", "s", 1, 1.0, 1.0, None), "WARNING", ["referential_integrity_customers"]),
        (("t", "", "p", None, 0, -1.0, -1.0, "n"), "FAILED",
         ["negative_net_amounts", "negative_or_zero_quantities", "negative_unit_prices",
          "null_customer_ids", "null_store_ids"]),
    ],
)
def test_audit(spark, row, status, failing):
    df = spark.createDataFrame([row], AUDIT.replace("transaction_date date, ", "")).withColumn(
        "transaction_date", F.current_date()
    )
    report = Q.quality_audit(df, df)
    checks = {r.check_name: r for r in Q.audit_checks(report).collect()}
    assert report.first().status == status and len(checks) == 9
    assert sorted(n for n, c in checks.items() if c.status != "PASSED") == failing
    assert checks["duplicate_transaction_ids"].details == "Found 0 duplicate transaction_ids"


def test_audit_counts_duplicate_ids(spark):
    row = ("t", "c", "p", "s", 1, 1.0, None, 1.0, "n")
    report = Q.quality_audit(spark.createDataFrame([row, row, row], AUDIT)).first()
    assert (report.duplicate_record_count, report.null_value_count, report.output_record_count) == (1, 3, 3)


def test_orphans(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parents = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in joins.orphan_keys(df, "k", parents, "id").collect()] == [(2, 2)]
    assert joins.orphan_rows(df, "k", parents, "id").count() == 2
    assert joins.orphan_key_count(df, "k", parents, "id").first()[0] == 1


def test_duplicate_dimension_keys_fan_out(spark):
    catalog = spark.createDataFrame(
        [("p", "A", "c", "b", 1.0, 1), ("p", "B", "c", "b", 1.0, 1)],
        "product_id string, product_name string, category string, brand string, price double, stock int",
    )
    assert joins.with_products(lines(spark, {}), catalog).count() == 2


def test_hot_key_join_is_split(spark):
    """With broadcasts off, adaptive execution splits the partition of a hot key."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        df = spark.range(0, 60000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("product_id"), F.col("id").alias("n")
        )
        catalog = spark.range(60000).select(
            F.col("id").alias("product_id"), F.lit("x").alias("product_name"), F.lit("c").alias("category"),
            F.lit("b").alias("brand"), F.lit(1.0).alias("price"), F.lit(1).alias("stock"),
        )
        joined = joins.with_products(df, catalog)
        assert len(joined.collect()) == 60000
        assert "skew=true" in joined._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_split_in_the_check_against_an_id_list(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        ids = spark.range(60000).select(F.col("id").cast("string").alias("customer_id"))
        df = spark.range(0, 60000, 1, 16).select(
            F.col("id").cast("string").alias("order_id"), F.lit("2024-01-02").alias("order_date"),
            F.when(F.col("id") % 3 == 0, " ").otherwise(F.col("id").cast("string")).alias("customer_id"),
            F.lit("p").alias("product_id"), F.lit("1").alias("quantity"), F.lit("2.5").alias("unit_price"),
        )
        valid = Q.check_order_lines(df, customers=ids).valid()
        assert len(valid.collect()) == 40000
        assert "skew=true" in valid._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


FEED = [
    ("1", "2024-01-02", "c1", "p1", "2", "2.50", "10", " north  EAST ", "card", "shipped", "F", "t"),
    ("1", "2024-01-02", "c1", "p1", "2", "2.50", "10", " north  EAST ", "card", "shipped", "F", "t"),
    ("2", "2024/01/03", "c2", "p1", "1", "4.00", None, None, "", " ", "F", "t"),
    ("3", "2024-01-03", "c2", "p1", "0", "4.00", None, None, "", "", "F", "t"),
]


def test_order_feed_end_to_end(spark, tmp_path):
    raw = spark.createDataFrame(FEED, RAW_ORDERS).withColumn("store_id", F.lit("s"))
    catalog = spark.createDataFrame(
        [("p1", "Mug", "Home", "Acme", 4.0, 1)],
        "product_id string, product_name string, category string, brand string, price double, stock int",
    )
    people = spark.createDataFrame(
        [("c1", "Ann", "Rome", None, "IT"), ("c2", "Bo", None, None, "FR")],
        "customer_id string, customer_name string, city string, state string, country string",
    )
    lake, house, reports = (str(tmp_path / n) for n in ("lake", "house", "reports"))
    for _ in range(2):  # a repeated feed changes nothing
        daily = process_order_feed(
            spark, raw, catalog, people, lake, house, reports, "b1", max_quarantine_pct=30.0
        )
    days = {str(r.order_date): r for r in daily.collect()}
    assert float(days["2024-01-02"].gross_revenue) == 5.0 and float(days["2024-01-02"].net_revenue) == 4.5
    stored = {r.order_id: r for r in spark.read.parquet(lake).collect()}
    assert stored["1"].region == "North East" and stored["2"].region == "Unknown"
    assert stored["2"].order_status == "Completed" and stored["2"].payment_method == "Unknown"
    assert stored["1"].order_status == "Shipped" and len(stored) == 2
    assert spark.read.json(f"{reports}/quarantine").count() == 1
    assert read_table(spark, house, "agg_daily_sales").count() == 2
    assert spark.read.json(f"{reports}/audit/batch=b1").first().status == "PASSED"
    with pytest.raises(Q.QualityGateError):
        admit(raw, reports, "b2", 10.0)
    # the rejected rows and the report are on disk before the gate raises
    assert spark.read.json(f"{reports}/validation/batch=b2").first().status == "FAILED"
