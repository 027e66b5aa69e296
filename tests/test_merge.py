import dataclasses
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillspark import schemas
from tillspark.operators import dedup, dimensions, merge
from tillspark.plans import geography, kpis, products, search
from tillspark.plans import warehouse as W
from tillspark.plans.curate import curate
from tillspark.sinks.versions import VersionedTable

OLD = [("a", 1, "x", "first"), ("b", 2, "y", "first")]
NEW = [("b", 3, None, "second"), ("c", 4, "z", "second")]
SCHEMA = "k string, n int, t string, seen string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_overwrites_with_nulls_and_keeps_frozen(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA)
    merged = merge.upsert(old, new, ["k"], frozen=["seen"])
    assert rows(merged) == [
        ("a", 1, "x", "first"),
        ("b", 3, None, "first"),
        ("c", 4, "z", "second"),
    ]
    assert rows(merge.upsert(merged, new, ["k"], frozen=["seen"])) == rows(merged)


def test_upsert_last_row_of_the_batch_wins(spark):
    old = spark.createDataFrame([], SCHEMA)
    new = spark.createDataFrame([("a", 1, "p", "s1"), ("a", 2, "q", "s2")], SCHEMA)
    merged = merge.upsert(old, new, ["k"], frozen=["seen"], order=["n"])
    assert rows(merged) == [("a", 2, "q", "s1")]


def test_upsert_keeps_columns_the_batch_lacks(spark):
    old, new = spark.createDataFrame(OLD, SCHEMA), spark.createDataFrame(NEW, SCHEMA).drop("n")
    merged = {r.k: r.n for r in merge.upsert(old, new, ["k"]).collect()}
    assert merged == {"a": 1, "b": 2, "c": None}
    with pytest.raises(ValueError):
        merge.upsert(old, new.drop("k"), ["k"])


def test_insert_ignore_keeps_first_and_is_repeatable(spark):
    old = spark.createDataFrame(OLD, SCHEMA)
    new = spark.createDataFrame(NEW + [("c", 3, "w", "third")], SCHEMA)
    merged = merge.insert_ignore(old, new, ["k"])
    assert rows(merged) == [("a", 1, "x", "first"), ("b", 2, "y", "first"), ("c", 3, "w", "third")]
    assert merge.new_rows(merged, new, ["k"]).count() == 0


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(
        F.col("id").alias("k"), F.lit(2024).alias("year"), (F.col("id") % 10).cast("int").alias("month")
    ).write.partitionBy("year", "month").parquet(path)
    batch = spark.createDataFrame([(3, 2024, 3), (103, 2024, 3)], "k bigint, year int, month int")
    stored = merge.touched_partitions(spark.read.parquet(path), batch, ["year", "month"])
    assert len(stored.inputFiles()) > 0
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "concat_ws(/" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert stored.count() == 10
    assert rows(merge.new_rows(stored, batch, ["k"])) == [(103, 2024, 3)]


@pytest.mark.parametrize("hot_share", [0.0, 0.5])
def test_first_per_key_against_a_plain_loop(spark, hot_share):
    data = [
        ("hot" if i < 200 * hot_share else f"k{i % 17}", (i * 7919) % 101, f"v{i % 13}")
        for i in range(200)
    ]
    expected = {}
    for k, n, v in data:
        expected[k] = min(expected.get(k, (n, v)), (n, v))
    found = dedup.first_per_key(spark.createDataFrame(data, "k string, n int, v string"), ["k"])
    assert {r.k: (r.n, r.v) for r in found.collect()} == expected


def test_first_per_key_on_key_columns_only(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(dedup.first_per_key(df, ["k"])) == [("a",), ("b",)]


RAW = [
    ("1", "a", "Cup", 2, "2011-01-05", Decimal("3.00"), "7", "France"),
    ("2", "a", "Cup blue", 1, "2011-02-05", Decimal("4.00"), "7", "Spain"),
    ("C3", "b", "Pot", -1, "2011-02-06", Decimal("9.00"), "", "France"),
]


def facts(spark, raw):
    return curate(
        spark.createDataFrame(raw, schemas.RAW_SALES), "T", F.lit("2020-01-01").cast("timestamp")
    )


def test_dimensions(spark):
    products = {r.stock_code: r for r in dimensions.dim_products(facts(spark, RAW)).collect()}
    assert (products["A"].description, products["A"].latest_unit_price) == ("Cup blue", Decimal("4.00"))
    assert (products["A"].total_units_sold, products["B"].total_units_sold) == (3, -1)
    lake = {r.stock_code: r for r in dimensions.dim_products_lake(facts(spark, RAW)).collect()}
    assert (lake["A"].latest_unit_price, lake["B"].total_units_sold) == (Decimal("3.50"), 0)
    customer = dimensions.dim_customers(facts(spark, RAW)).collect()
    assert len(customer) == 1 and customer[0].country == "France" and customer[0].total_orders == 2
    assert customer[0].total_spend == Decimal("10.00")


def test_warehouse_load_twice_then_more(spark, tmp_path):
    lake, house = str(tmp_path / "lake"), str(tmp_path / "house")

    def write(raw):
        facts(spark, raw).write.mode("overwrite").partitionBy(
            "transaction_year", "transaction_month"
        ).parquet(lake)

    write(RAW)
    first = W.load_warehouse(spark, lake, house)
    assert first["fact_rows_inserted"] == 3 and first["dim_products_count"] == 2
    before = rows(W.read_table(spark, house, "dim_products"))
    assert W.load_warehouse(spark, lake, house)["fact_rows_inserted"] == 0
    assert rows(W.read_table(spark, house, "dim_products")) == before
    write([("0", "a", "Cup old", 5, "2010-01-05", Decimal("1.00"), "8", "France"), *RAW])
    third = W.load_warehouse(spark, lake, house)
    assert third["fact_rows_inserted"] == 1 and third["dim_customers_count"] == 2
    cup = W.read_table(spark, house, "dim_products").where("stock_code = 'A'").first()
    # units follow the data, the first sale keeps the date that was loaded first
    assert cup.total_units_sold == 8 and cup.first_sold_at == datetime(2011, 1, 5)


def sales(spark, *lines):
    """Curated lines from (invoice, stock, quantity, day, customer, country)."""
    raw = [(i, s, f"{s} at {d}", q, d, Decimal("2.00"), c, n) for i, s, q, d, c, n in lines]
    return facts(spark, raw)


FIRST = [
    ("1", "a", 2, "2011-01-05", "7", "France"), ("1", "b", 1, "2011-01-05", "7", "France"),
    ("2", "a", 1, "2011-02-05", "7", "Spain"), ("C3", "b", -1, "2011-02-06", "", "France"),
    ("4", "c", 5, "2011-02-07", "8", "Italy"), ("5", None, 5, "2011-02-07", "8", "Italy"),
]
LATER = [
    ("2", "b", 3, "2011-02-05", "7", "Spain"),  # a late line of a known invoice
    ("2", "a", 1, "2011-02-05", "7", "Spain"),  # delivered again
    ("6", "a", 4, "2011-03-05", "9", "France"), ("7", None, 1, "2011-03-05", "8", "Malta"),
]


def dims(spark, house):
    return {name: rows(W.read_table(spark, house, name)) for name in W.DIMENSIONS}


def rebuilt(spark, lines):
    whole = sales(spark, *lines)
    return {"dim_products": rows(W.products_of(W.product_states(whole))),
            "dim_customers": rows(W.customers_of(W.customer_states(whole)))}


def test_incremental_dimensions_equal_a_rebuild(spark, tmp_path):
    house = str(tmp_path / "house")
    for lines, seen in ((FIRST, FIRST), (LATER, FIRST + LATER), (LATER, FIRST + LATER)):
        W.load_fact(spark, sales(spark, *lines), house)
        W.refresh_dimensions(spark, house)
        assert dims(spark, house) == rebuilt(spark, seen)


def test_a_load_reads_only_what_the_fact_gained(spark, tmp_path, monkeypatch):
    house = str(tmp_path / "house")
    W.load_fact(spark, sales(spark, *FIRST), house)
    W.refresh_dimensions(spark, house)
    W.load_fact(spark, sales(spark, *LATER), house)
    fact = VersionedTable(spark, f"{house}/fact_sales")
    gained = {f.partition("/")[0] for f in fact.version().added}
    read, real = [], W.product_states

    def spy(facts):
        read.extend(facts.inputFiles())
        return real(facts)

    dimension = W.DIMENSIONS["dim_products"]
    kept = dataclasses.replace(dimension.states, made=spy)
    monkeypatch.setitem(W.DIMENSIONS, "dim_products", dataclasses.replace(dimension, states=kept))
    W.refresh_dimensions(spark, house)
    assert read and {f.split("/fact_sales/")[1].partition("/")[0] for f in read} == gained
    read.clear()
    before = VersionedTable(spark, f"{house}/dim_products").numbers()
    W.refresh_dimensions(spark, house)
    assert read == [] and VersionedTable(spark, f"{house}/dim_products").numbers() == before


def test_states_are_compacted_without_change(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "STATE_FOLDERS", 2)
    house, seen = str(tmp_path / "house"), []
    for line in FIRST + LATER:
        seen.append(line)
        W.load_fact(spark, sales(spark, line), house)
        W.refresh_dimensions(spark, house)
    assert dims(spark, house) == rebuilt(spark, seen)
    assert len(VersionedTable(spark, f"{house}/dim_products_states").version().folders) <= 2


@pytest.mark.parametrize("step", ["add_kept", "refresh_dimension"])
def test_a_refresh_cut_short_counts_no_row_twice(spark, tmp_path, monkeypatch, step):
    house = str(tmp_path / "house")
    W.load_fact(spark, sales(spark, *FIRST), house)
    real = getattr(W, step)

    def cut(*args):
        real(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(W, step, cut)
    with pytest.raises(KeyboardInterrupt):
        W.refresh_dimensions(spark, house)
    monkeypatch.setattr(W, step, real)
    W.refresh_dimensions(spark, house)
    assert dims(spark, house) == rebuilt(spark, FIRST)


def test_rollup_reports_equal_reports_over_the_fact(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "STATE_FOLDERS", 2)
    house = str(tmp_path / "house")
    for lines in (FIRST, LATER, [("9", "z", -2, "2011-03-07", "70000", "Malta")], [("9", "y", 2, "2011-03-07", "70000", "Malta")]):
        W.load_fact(spark, sales(spark, *lines), house)
        rolled = W.refresh_rollups(spark, house)
    facts = W.read_table(spark, house, "fact_sales")
    for ours, theirs in (
        (rolled.kpi_summary(), kpis.kpi_summary(facts)),
        (rolled.sales_kpis(), kpis.sales_kpis(facts)),
        (rolled.sales_kpis(year=2012), kpis.sales_kpis(facts, year=2012)),
        (rolled.sales_kpis(2011, "International", domestic="France"), kpis.sales_kpis(facts, 2011, "International", domestic="France")),
        (rolled.sales_trends(), kpis.sales_trends(facts)),
        (rolled.geographic_sales(), geography.geographic_sales(facts)),
        (rolled.top_products(3), products.top_products(facts, 3)),
        (rolled.top_products(order_by="units", region="Malta"), products.top_products(facts, order_by="units", region="Malta")),
    ):
        assert ours.columns == theirs.columns and rows(ours) == rows(theirs)


def test_loads_at_once_store_every_key_once(spark, tmp_path):
    house = str(tmp_path / "house")
    W.load_fact(spark, sales(spark, *FIRST[:2]), house)
    with ThreadPoolExecutor(3) as pool:
        counts = list(pool.map(lambda lines: W.load_fact(spark, sales(spark, *lines), house), [FIRST, LATER, FIRST + LATER]))
        list(pool.map(lambda _: W.refresh_dimensions(spark, house), range(3)))
    stored = W.read_table(spark, house, "fact_sales").select("invoice_no", "stock_code", "invoice_date", "quantity")
    assert stored.count() == stored.distinct().count() == 9 and sum(counts) == 7
    assert dims(spark, house) == rebuilt(spark, FIRST + LATER)


def test_keys_of_other_files_are_not_read(spark, tmp_path):
    house = str(tmp_path / "house")
    early, late = sales(spark, *FIRST), sales(spark, ("8", "a", 1, "2011-01-09", "7", "France"))
    W.load_fact(spark, early, house)
    W.load_fact(spark, late, house)
    table = VersionedTable(spark, f"{house}/fact_sales", ["transaction_year", "transaction_month"])
    index, version = W.KeyIndex(table, W.K.SALES_KEY), table.version()
    january = version.in_partitions(["transaction_year=2011/transaction_month=1"])
    assert len(january) == 2
    again = index.matching(version, january, late).inputFiles()
    assert len(again) == 1 and version.added[0] in again[0]
    fresh = sales(spark, ("99", "a", 1, "2011-01-09", "7", "France"))
    assert index.matching(version, january, fresh).inputFiles() == []


def test_searches_use_the_index_of_the_fact(spark, tmp_path):
    house = str(tmp_path / "house")
    W.load_fact(spark, sales(spark, *FIRST), house)
    assert len(W.index_searches(spark, house).refresh()) == 0
    W.load_fact(spark, sales(spark, *LATER), house)
    fact = W.read_table(spark, house, "fact_sales")
    for text in ("a at 2011-02", "A AT 2011-03", "%", "9", "no such"):
        # the newest files have no index yet, later they have
        for _ in range(2):
            found = search.indexed_lines(VersionedTable(spark, f"{house}/fact_sales", W.K.SALES_PARTITIONS), text)
            assert rows(found) == rows(search.matching_lines(fact, text))
            W.index_searches(spark, house)
    assert search.indexed_lines(VersionedTable(spark, f"{house}/fact_sales"), "no such").inputFiles() == []


def test_only_changed_lake_partitions_are_read(spark, tmp_path, monkeypatch):
    lake, house = str(tmp_path / "lake"), str(tmp_path / "house")
    table = VersionedTable(spark, lake, W.K.SALES_PARTITIONS)
    table.append(sales(spark, *FIRST))
    assert W.load_warehouse(spark, lake, house)["fact_rows_inserted"] == 6
    table.append(sales(spark, *LATER[2:]))
    read, real = [], W.read_lake_partitions

    def spy(spark, path, places):
        read.append(places)
        return real(spark, path, places)

    monkeypatch.setattr(W, "read_lake_partitions", spy)
    assert W.load_warehouse(spark, lake, house)["fact_rows_inserted"] == 2
    assert W.load_warehouse(spark, lake, house)["fact_rows_inserted"] == 0
    assert read == [["transaction_year=2011/transaction_month=3"]]


def test_daily_and_order_line_loads(spark, tmp_path):
    house = str(tmp_path)
    day = date(2024, 1, 2)
    one = Decimal("1.00")
    daily = spark.createDataFrame([(day, "s", "c", 1, 2, one, one, one)], schemas.DAILY_SALES)
    W.load_daily_sales(spark, daily, house)
    assert W.load_daily_sales(spark, daily, house).count() == 1
    lines = spark.createDataFrame(
        [("o", "p", 1, date(2024, 1, 2)), ("o", "q", 1, date(2024, 1, 2)), ("r", "p", 1, date(2024, 2, 2))],
        "order_id string, product_id string, quantity int, order_date date",
    )
    assert W.load_order_lines(spark, lines, house).count() == 3
    table = VersionedTable(spark, f"{house}/order_lines", ["order_month"])
    kept = table.version().in_partitions(["order_month=2024-01"])
    late = lines.where("order_id = 'r'").withColumn("quantity", F.lit(9))
    stored = W.load_order_lines(spark, late, house)
    assert rows(stored.select("order_id", "product_id", "quantity")) == [("o", "p", 1), ("o", "q", 1), ("r", "p", 9)]
    assert table.version().in_partitions(["order_month=2024-01"]) == kept and len(kept) == 1
    assert W.load_order_lines(spark, late.limit(0), house).count() == 3


def test_daily_aggregates_without_category_are_stored_once(spark, tmp_path):
    one = Decimal("1.00")
    daily = spark.createDataFrame([(date(2024, 1, 2), "s", None, 1, 2, one, one, one)], schemas.DAILY_SALES)
    assert [W.load_daily_sales(spark, daily, str(tmp_path)).count() for _ in range(3)] == [1, 1, 1]


def test_null_keys_meet(spark):
    schema = "k string, j int, v int"
    old = spark.createDataFrame([(None, 1, 1), ("a", None, 2)], schema)
    new = spark.createDataFrame([(None, 1, 3), ("a", None, 4), ("b", None, 5)], schema)
    assert rows(merge.upsert(old, new, ["k", "j"])) == rows(new)
    assert rows(merge.new_rows(old, new, ["k", "j"])) == [("b", None, 5)]
    assert merge.insert_ignore(merge.insert_ignore(old, new, ["k", "j"]), new, ["k", "j"]).count() == 3


def test_only_touched_days_are_rewritten(spark, tmp_path):
    one = Decimal("1.00")

    def daily(day, orders):
        return spark.createDataFrame([(day, "s", "c", orders, 2, one, one, one)], schemas.DAILY_SALES)

    house = str(tmp_path)
    W.load_daily_sales(spark, daily(date(2024, 1, 2), 1), house)
    table = VersionedTable(spark, f"{house}/agg_daily_sales", ["sale_date"])
    kept = table.version().in_partitions(["sale_date=2024-01-02"])
    stored = W.load_daily_sales(spark, daily(date(2024, 1, 3), 5), house)
    assert stored.columns == [f.split()[0] for f in schemas.DAILY_SALES.split(", ")]
    assert table.version().in_partitions(["sale_date=2024-01-02"]) == kept and len(kept) == 1
    stored = W.load_daily_sales(spark, daily(date(2024, 1, 3), 7), house)
    assert sorted(r.total_orders for r in stored.collect()) == [1, 7]


def test_masters(spark, tmp_path):
    house = str(tmp_path)
    products = spark.createDataFrame(
        [("P1", "Mug", "Home", "Acme", 2.5, 3)],
        "product_id string, product_name string, category string, brand string, unit_price double, stock int",
    )
    people = spark.createDataFrame([("C1", "Ann", "Rome")], "customer_id string, customer_name string, city string")
    assert W.seed_masters(spark, {"products": products, "customers": people}, house) == ["products", "customers"]
    stored = W.read_table(spark, house, "products").first()
    assert stored.price == 2.5 and stored.stock == 3
    # without a stock column the stored stock stays
    again = W.sync_master(spark, products.drop("stock").withColumn("unit_price", F.lit(3.0)), house, "products")
    assert tuple(again.select("price", "stock").first()) == (3.0, 3)
    # seeding adds unknown keys and leaves stored rows alone
    W.seed_masters(spark, {"products": products.union(products.withColumn("product_id", F.lit("P2")))}, house)
    stored = {r.product_id: r.price for r in W.read_table(spark, house, "products").collect()}
    assert stored == {"P1": 3.0, "P2": 2.5}


def test_empty_warehouse_is_refused(spark, tmp_path):
    with pytest.raises(W.QualityGateError):
        W.require_loaded(W.warehouse_counts(spark, str(tmp_path)))


def test_daily_sales_are_dealt_more_widely_as_files_grow(spark, tmp_path, monkeypatch):
    from tillspark import session
    from tillspark.operators import rollups

    rows = spark.range(400).selectExpr(
        "date'2024-01-01' as sale_date", "cast(id % 5 as string) as store_id", "'c' as category", "id div 2 as order_id",
        "cast(1 as int) as quantity", "cast(2 as decimal(12,2)) as gross_amount",
        "cast(1 as decimal(12,2)) as discount_amount", "cast(1 as decimal(12,2)) as net_amount",
    )
    rows.write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    expected = sorted(map(tuple, rollups.daily_sales(stored).collect()))
    assert [r[3] for r in expected] == [80] * 5 and sum(r[4] for r in expected) == 400
    monkeypatch.setattr(session, "BYTES_PER_TASK", 500)
    assert session.dealt_by(stored, "order_id").rdd.getNumPartitions() > 8
    assert sorted(map(tuple, rollups.daily_sales(stored).collect())) == expected
