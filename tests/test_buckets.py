"""Co-partitioned tables: the same rows as ordinary joins and merges, without moving the table."""

import pytest
from pyspark.sql import functions as F

from tillspark.operators import joins, merge
from tillspark.sinks import buckets as B

LINES = "order_id int, customer_id int, amount int"


@pytest.fixture
def without_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def lines(spark):
    """A third of the rows belong to customer 7, some to nobody."""
    return spark.range(3000).select(
        F.col("id").cast("int").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, (F.col("id") % 200).cast("int")).alias("customer_id"),
        (F.col("id") % 11).cast("int").alias("amount"),
    )


def customers(spark):
    return spark.range(150).select(F.col("id").cast("int").alias("customer_id"), F.concat(F.lit("c"), "id").alias("customer_name"))


def test_bucketed_join_equals_the_plain_one_without_moving_the_lines(spark, tmp_path, without_broadcasts):
    fact = B.write_buckets(lines(spark), str(tmp_path / "fact"), ["customer_id"], buckets=8)
    people = B.write_buckets(customers(spark), str(tmp_path / "people"), ["customer_id"], buckets=8, hot=False)
    hot = {r[0] for r in fact.apart().select("customer_id").distinct().collect()}
    assert hot == {7, None}
    names = {"customer_name": "name"}
    joined = B.with_attributes(fact, people, names)
    assert found(joined) == found(joins.with_attributes(lines(spark), customers(spark), "customer_id", names))
    wanted = people.even().select(F.col("customer_id").alias("_key"), "customer_name")
    even = fact.even().join(wanted, F.col("customer_id") == F.col("_key"), "left")
    plan = even._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_layout_is_known_to_another_session(spark, tmp_path):
    table = B.write_buckets(lines(spark), str(tmp_path / "t"), ["customer_id"], buckets=4)
    spark.sql(f"drop table {table._name}")
    again = B.BucketedTable.open(spark, str(tmp_path / "t"))
    assert again == table and found(again.read()) == found(lines(spark))
    with pytest.raises(FileExistsError):
        B.write_buckets(lines(spark), str(tmp_path / "t"), ["customer_id"])
    B.drop_buckets(again)
    assert not (tmp_path / "t").exists()


def test_bucketed_upsert_equals_the_plain_one(spark, tmp_path, without_broadcasts):
    stored = lines(spark).where("order_id < 2000").unionByName(spark.createDataFrame([(None, 1, 1), (None, 2, 2)], LINES).limit(1))
    batch = lines(spark).where("order_id >= 1500").withColumn("amount", F.col("amount") + 100)
    batch = batch.unionByName(batch.limit(50).withColumn("amount", F.lit(999))).unionByName(spark.createDataFrame([(None, 5, 5)], LINES))
    table = B.write_buckets(stored, str(tmp_path / "t"), ["order_id"], buckets=8)
    new = B.upsert_buckets(table, batch, str(tmp_path / "new"), order=["amount"])
    assert found(new.read()) == found(merge.upsert(stored, batch, ["order_id"], order=["amount"]))
    assert found(table.read()) == found(stored)
    files = [f for f in (tmp_path / "new" / "even").iterdir() if f.suffix == ".parquet"]
    assert len(files) <= 8  # every task wrote the one bucket it had
    third = B.upsert_buckets(new, batch, str(tmp_path / "third"), order=["amount"])
    assert found(third.read()) == found(new.read())


def test_upsert_of_keys_stored_apart(spark, tmp_path):
    rows = [(7, i, i) for i in range(50)] + [(i, i, i) for i in range(10, 40)]
    table = B.write_buckets(spark.createDataFrame(rows, LINES), str(tmp_path / "t"), ["order_id"], buckets=16)
    assert table.apart().count() == 50
    batch = spark.createDataFrame([(7, 1, 500), (11, 1, 600), (99, 1, 700)], LINES)
    new = B.upsert_buckets(table, batch, str(tmp_path / "new"))
    assert found(new.read()) == found(merge.upsert(spark.createDataFrame(rows, LINES), batch, ["order_id"]))


def test_bucket_counts():
    assert [B.bucket_count(n) for n in (0, 1, 2_000_000, 2_000_001, 9_000_000)] == [1, 1, 1, 2, 8]


def test_a_load_moves_no_stored_row_and_reduces_hot_keys_of_the_batch(spark, tmp_path, without_broadcasts, monkeypatch):
    merged = []
    monkeypatch.setattr(B, "_write_even", lambda t, rows, write=B._write_even: (merged.append(rows), write(t, rows)))
    stored = lines(spark).where("customer_id is not null").dropDuplicates(["customer_id", "order_id"])
    keys = ["order_id", "customer_id"]
    batch = lines(spark).withColumn("amount", F.col("amount") + 1).where("order_id > 2000")
    repeated = batch.unionByName(spark.range(5000).selectExpr("2001 as order_id", "51 as customer_id", "cast(id as int) as amount"))
    table = B.write_buckets(stored, str(tmp_path / "t"), keys, buckets=4)  # the session has 8 shuffle partitions
    loaded = B.upsert_buckets(table, repeated, str(tmp_path / "u"), order=["amount"])
    assert found(loaded.read()) == found(merge.upsert(stored, repeated, keys, order=["amount"]))
    plan = merged[-1]._jdf.queryExecution().executedPlan().toString()
    stored_side = plan[plan.index("FullOuter") :].partition("Bucketed: true")[0]
    assert "Exchange" not in stored_side and "Bucketed: true" in plan


def test_hot_keys_are_found_in_busy_slots_only(spark, monkeypatch):
    for slots in (65536, 2):
        monkeypatch.setattr(B, "HASH_SLOTS", slots)
        assert [r[0] for r in B._hot_keys(lines(spark).where("customer_id is not null"), ["customer_id"], 500).collect()] == [7]
        assert B._hot_keys(lines(spark), ["order_id"], 1).collect() == []


def test_registered_tables_get_more_buckets_as_they_grow(spark, monkeypatch):
    from registry import load_queries

    monkeypatch.setattr(B, "ROWS_PER_BUCKET", 100)
    assert load_queries._buckets(lines(spark)) == 32 and load_queries._buckets(customers(spark)) == 8
