"""Versioned tables: whole versions, concurrent loads, crashes at every step."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tillspark.functions.text import any_contains
from tillspark.session import staged, staging
from tillspark.sinks import versions as V

SCHEMA = "k int, v string, m int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


def test_versions_are_whole_and_stay_readable(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.append(frame(spark, (1, "a", 1))) == 1
    first = table.version()
    table.append(frame(spark, (2, "b", 1)))
    table.replace(lambda base: table.read(base).where("k = 2"))
    assert found(table.read(first)) == [(1, "a", 1)]
    assert found(table.read(table.version(2))) == [(1, "a", 1), (2, "b", 1)]
    assert found(table.read()) == [(2, "b", 1)] and table.numbers() == [1, 2, 3]
    assert table.read().columns == ["k", "v", "m"]


def test_partitions_are_replaced_alone(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"), ["m"])
    table.append(frame(spark, (1, "a", 1), (2, "b", 2), (3, "c", None)))
    before = table.version()
    kept = before.in_partitions(["m=2"])
    table.replace_partitions(lambda base: frame(spark, (1, "z", 1), (4, "y", 1)))
    assert found(table.read().where("m is not null")) == [(1, "z", 1), (2, "b", 2), (4, "y", 1)]
    assert table.version().in_partitions(["m=2"]) == kept
    table.replace_partitions(lambda base: frame(spark), ["m=1"])
    assert table.read().where("m = 1").count() == 0 and table.read().where("m is null").count() == 1
    plan = table.read().where("m = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_added_since(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"))
    for k in (1, 2, 3):
        table.append(frame(spark, (k, "a", 1)))
    newest, folders = table.added_since(1)
    assert newest.number == 3 and found(table.read(newest, folders)) == [(2, "a", 1), (3, "a", 1)]
    table.replace(lambda base: table.read(base))
    assert table.added_since(1)[1] is None and table.added_since(4)[1] == []


def test_appends_at_once_lose_nothing(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"), ["m"])
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: table.append(frame(spark, (k, "a", k % 2))), range(12)))
    assert [r[0] for r in found(table.read())] == list(range(12)) and table.numbers() == list(range(1, 13))


def test_read_modify_write_at_once_loses_nothing(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, (0, "sum", 0)))

    def add(_):
        return table.replace(lambda base: table.read(base).select("k", "v", (F.col("m") + 1).alias("m")))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(8)))
    assert found(table.read()) == [(0, "sum", 8)]


def test_loads_of_other_partitions_are_built_upon(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"), ["m"])
    table.append(frame(spark, (1, "a", 1), (2, "b", 2)))
    built = []

    def slow(base):
        built.append(base.number)
        if len(built) == 1:  # another load of another partition comes first
            table.replace_partitions(lambda b: frame(spark, (2, "other", 2)))
        return frame(spark, (1, "mine", 1))

    table.replace_partitions(slow)
    assert built == [1] and found(table.read()) == [(1, "mine", 1), (2, "other", 2)]

    def same(base):
        built.append(base.number)
        if len(built) == 2:
            table.replace_partitions(lambda b: frame(spark, (1, "first", 1)))
        return table.read(base).where("m = 1").withColumn("v", F.concat("v", F.lit(" then mine")))

    table.replace_partitions(same)
    assert len(built) == 3 and found(table.read())[0] == (1, "first then mine", 1)


@pytest.mark.parametrize("step", ["write", "write_text", "move_path"])
def test_a_crash_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch, step):
    table = V.VersionedTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, (1, "a", 1)))
    place = V.VersionedTable if step == "write" else V
    real = getattr(place, step)

    def crash(*args):
        if step == "write":
            real(*args)  # the data is there, its version is not
        raise KeyboardInterrupt

    monkeypatch.setattr(place, step, crash)
    with pytest.raises(KeyboardInterrupt):
        table.replace(lambda base: frame(spark, (9, "new", 9)))
    monkeypatch.setattr(place, step, real)
    assert found(table.read()) == [(1, "a", 1)]
    table.replace(lambda base: frame(spark, (9, "new", 9)))
    assert found(table.read()) == [(9, "new", 9)] and table.numbers() == [1, 2]


def test_a_crash_after_the_rename_leaves_the_new_version(spark, tmp_path, monkeypatch):
    table = V.VersionedTable(spark, str(tmp_path / "t"))
    table.append(frame(spark, (1, "a", 1)))
    real = V.move_path

    def crash(*args):
        real(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(V, "move_path", crash)
    with pytest.raises(KeyboardInterrupt):
        table.replace(lambda base: frame(spark, (9, "new", 9)))
    assert found(table.read()) == [(9, "new", 9)]


def test_vacuum_keeps_live_and_young_folders(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"))
    for k in range(4):
        table.replace(lambda base: frame(spark, (k, "a", 1)))
    assert table.vacuum() == []
    assert len(table.vacuum(keep=2, older_than_s=-5)) == 2
    assert table.numbers() == [3, 4] and found(table.read()) == [(3, "a", 1)]
    assert found(table.read(table.version(3))) == [(2, "a", 1)]


def test_clustered_files_hold_ranges(spark, tmp_path):
    table = V.VersionedTable(spark, str(tmp_path / "t"), ["m"])
    rows = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"), F.lit(1).alias("m"))
    folders, _ = table.write(rows.repartition(5), cluster=["k"])
    table.commit(table.version(), V.Change(folders, schema=rows.schema))
    spans = table.read().groupBy(F.input_file_name()).agg(F.min("k"), F.max("k"), F.count("*")).collect()
    assert all(high - low + 1 == n for _, low, high, n in spans)


KEYED = "a string, b int, m string"


def keyed(spark, *rows):
    return spark.createDataFrame(rows, KEYED)


def indexed_table(spark, path, *loads, partitions=("m",)):
    table = V.VersionedTable(spark, path, list(partitions))
    index = V.KeyIndex(table, ["a", "b"])
    for rows in loads:
        folders, _ = table.write(rows, cluster=["a"])
        index.add(folders, rows.schema)
        table.commit(table.version(), V.Change(folders, schema=rows.schema))
    return table, index


def test_index_finds_every_stored_key_and_few_others(spark, tmp_path):
    odd = "x+y z:1=%"  # a partition value that its folder's name has to escape
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("k"), "id")).alias("a"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 1000).cast("int")).alias("b"),
        F.when(F.col("id") % 3 != 0, F.lit(odd)).alias("m"),
    )
    table, index = indexed_table(spark, str(tmp_path / "t"), rows.where("b > 500 or b is null"), rows.where("b <= 500"))
    version = table.version()
    stored = index.matching(version, version.folders, rows.where("a in ('k14', 'k21', 'k28')"))
    first_commit = {f.partition("/")[0] for f in version.folders if f in table.version(1).folders}
    assert {f.split("/t/")[1].partition("/")[0] for f in stored.inputFiles()} == first_commit
    batch = rows.where("b % 50 = 3")
    found = index.matching(version, version.folders, batch).select("a", "b", "m").distinct()
    assert batch.distinct().exceptAll(found).count() == 0
    absent = rows.select(F.concat(F.lit("k"), F.lit("1"), "a").alias("a"), "b", "m").where("a is not null").limit(50)
    fresh = index.matching(version, version.folders, absent.withColumn("m", F.lit("elsewhere")))
    assert fresh.inputFiles() == [] and fresh.count() == 0


def test_filter_lets_few_absent_keys_pass(spark):
    from tillspark.operators import fileindex

    rows = spark.range(20_000).select(F.lit("f").alias("_file"), F.col("id").alias("k"))
    index = fileindex.index_rows(rows, ["k"]).cache()
    assert index.count() == 10
    stored = {r["k"] for r in rows.sample(0.01, 1).collect()}
    assert len(stored) > 100
    for k in list(stored)[:5]:
        assert fileindex.files_that_may_hold(index, spark.range(k, k + 1).toDF("k"), ["k"]).count() == 1
    # absent keys inside the range: halves between the stored ones
    wide = rows.withColumn("k", 2 * F.col("k"))
    index = fileindex.index_rows(wide, ["k"]).cache()
    files = wide.select("_file").distinct()
    absent = spark.range(400).select((2 * F.col("id") + 1).alias("k"))
    assert files.count() == 1
    passed = sum(fileindex.files_that_may_hold(index, absent.where(f"k = {2 * i + 1}"), ["k"]).count() for i in range(25))
    assert passed <= 2


def test_folders_without_an_index_are_read(spark, tmp_path):
    table, index = indexed_table(spark, str(tmp_path / "t"), keyed(spark, ("a", 1, "x")))
    table.append(keyed(spark, ("b", 1, "x")))
    version = table.version()
    assert found(index.matching(version, version.folders, keyed(spark, ("zz", 1, "x")))) == [("b", 1, "x")]


TEXTS = "a string, b string, n int, m int"


def searchable(spark, path):
    rows = [(f"inv{i:04d}", f"Mug {'blau' if i % 40 == 7 else 'ROT'} É{i}", i, i // 50) for i in range(200)]
    rows += [(None, None, 900, 3), ("xy", "", 901, 3), ("50%", "a_b\\c", 902, 3)]
    df = spark.createDataFrame(rows, TEXTS)
    table = V.VersionedTable(spark, path, ["m"])
    folders, _ = table.write(df, cluster=["a"])
    V.TextIndex(table, ["a", "b", "n"]).add(folders, df.schema)
    table.commit(table.version(), V.Change(folders, schema=df.schema))
    return table, df


@pytest.mark.parametrize(
    "term", ["inv0007", "INV00", "blau", "Mug rot", "é19", "mug%é1", "nv_00", "xy", "%", "_b\\", "50%", "90", "902", "absent", "Mug blau inv"]
)
def test_trigram_search_finds_what_a_scan_finds(spark, tmp_path, term):
    table, df = searchable(spark, str(tmp_path / "t"))
    read = V.TextIndex(table, ["a", "b", "n"]).containing(table.version(), term)
    for case in (False, True):
        wanted = any_contains(["a", "b", "n"], term, case)
        assert found(read.where(wanted)) == found(df.where(wanted))


def test_trigram_search_leaves_files_out(spark, tmp_path):
    table, _ = searchable(spark, str(tmp_path / "t"))
    index, version = V.TextIndex(table, ["a", "b", "n"]), table.version()
    assert len(version.folders) == 4
    assert [f.split("/")[-2] for f in index.containing(version, "inv0007").inputFiles()] == ["m=0"]
    assert index.containing(version, "no such text").inputFiles() == []
    # all trigrams occur, but not in the same column
    assert index.containing(version, "inv00blau").inputFiles() == []


def scanned_rows(df):
    """Rows that the file scan of an executed query put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while "Scan" not in plan.nodeName() or "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan() if "Adaptive" in plan.nodeName() else plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_a_search_for_one_value_skips_row_groups(spark, tmp_path):
    rows = spark.range(60_000, numPartitions=1).select(
        F.concat(F.lit("i"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("a"),
        (F.xxhash64("id") % 1_000_000_000 * 2).alias("customer"),
    )
    probe = rows.orderBy("a").offset(30_000).first()
    counts = {}
    for name, sought in (("plain", []), ("sought", ["customer"])):
        table = V.VersionedTable(spark, str(tmp_path / name))
        folders, _ = table.write(rows.coalesce(1), cluster=["a"], sought=sought, **{"parquet.block.size": 64 * 1024})
        table.commit(table.version(), V.Change(folders, schema=rows.schema))
        assert scanned_rows(table.read().where(F.col("a") == probe["a"])) < 30_000  # by the order inside
        wanted = table.read().where(F.col("customer") == probe["customer"])
        counts[name] = scanned_rows(wanted)
        assert found(wanted) == [tuple(probe)]
    assert counts["plain"] == 60_000 and counts["sought"] < 30_000


def test_scopes_of_threads_are_apart(spark):
    inside, leave = threading.Event(), threading.Event()

    def job():
        with staging(spark):
            inside.set()
            leave.wait(30)

    thread = threading.Thread(target=job)
    thread.start()
    inside.wait(30)
    table = staged(spark.range(3), "other-thread")
    leave.set()
    thread.join()
    assert table.count() == 3


def test_file_names_are_decoded_once_per_index_row(spark, tmp_path):
    from tillspark.operators import fileindex

    table = V.VersionedTable(spark, str(tmp_path / "t"), ["day"])
    folders, _ = table.write(spark.range(50).select("id", F.lit("a+b c%").alias("day")))
    index = V.KeyIndex(table, ["id"])
    schema = table.read(V.Version(schema=spark.createDataFrame([], "id long, day string").schema), folders).schema
    rows = table.read(V.Version(schema=schema), folders, files=True)
    assert "url_decode" not in rows._jdf.queryExecution().optimizedPlan().toString()
    index.add(folders, schema)
    table.commit(table.version(), V.Change(folders, schema=schema))
    names = {r[0] for r in spark.read.parquet(f"{index.path}/{folders[0].partition('/')[0]}").select(fileindex.FILE).collect()}
    assert names and all((tmp_path / "t" / n).exists() for n in names)
    version = table.version()
    assert index.matching(version, version.folders, spark.range(7, 8).select("id", F.lit("a+b c%").alias("day"))).count() > 0
