"""Session construction and the shared folder for staged tables."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import re
import shutil
import tempfile
import time
import uuid
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parent

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even where that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "tillspark", master: str | None = None, **settings: str
) -> SparkSession:
    """A session in UTC with adaptive execution on.

    Shuffle width is left to the cluster's own configuration: adaptive execution
    coalesces from there, and a fixed small number would not survive large inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tillspark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Where ``spark.checkpoint.dir`` is unset, only a session whose executor is the driver
    itself gets a folder of its own; any other master, ``local-cluster`` too, is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch(context.applicationId)


@functools.cache
def _shipped(context: SparkContext) -> None:
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='tillspark-')}/tillspark", "zip", PACKAGE.parent, PACKAGE.name)
    context.addPyFile(archive)


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever they run and however it was imported."""
    _shipped(spark.sparkContext)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system for ``path``, whatever storage it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, system = _file_system(spark, path)
    return system.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    place, system = _file_system(spark, path)
    system.delete(place, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; raises where that fails."""
    place, system = _file_system(spark, source)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")


def list_folder(spark: SparkSession, path: str, older_than_s: float | None = None) -> list[str]:
    """Names in a folder, none where it does not exist; only those unchanged for so many seconds."""
    place, system = _file_system(spark, path)
    if not system.exists(place):
        return []
    latest = None if older_than_s is None else 1000 * (time.time() - older_than_s)
    entries = system.listStatus(place)
    return [e.getPath().getName() for e in entries if latest is None or e.getModificationTime() <= latest]


def list_states(spark: SparkSession, path: str) -> list[str]:
    """Name, length and time of change of every file in a folder."""
    place, system = _file_system(spark, path)
    return [f"{e.getPath().getName()} {e.getLen()} {e.getModificationTime()}" for e in system.listStatus(place)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file."""
    place, system = _file_system(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small UTF-8 file, which must not exist yet."""
    place, system = _file_system(spark, path)
    stream = system.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


# of input files, for a task that holds its rows in memory
BYTES_PER_TASK = 16_000_000


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is made of."""
    total = 0
    for path in df.inputFiles():
        place, system = _file_system(df.sparkSession, path)
        total += system.getFileStatus(place).getLen()
    return total


def dealt_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys in one partition; one for each ``BYTES_PER_TASK`` of the files that ``df`` is made of.

    There are at least as many as the session's shuffles have. For aggregates whose groups are about as
    many as their rows: a session's number of partitions does not grow with its tables.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(usual, -(-input_bytes(df) // BYTES_PER_TASK)), *keys)


# the shuffle files of a query go when it ends; else they stay until the driver happens to collect its
# garbage, so that those of all steps add up. Not for a DataFrame that is run twice: it shuffles twice.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# a scan's task reads so much, whatever the session's own size is
SMALL_READS = {"spark.sql.files.maxPartitionBytes": str(BYTES_PER_TASK)}
# a task keeps a file open for each of so many partitions and does not have to sort its rows by them
FILES_AT_ONCE = {"spark.sql.maxConcurrentOutputFileWriters": "32"}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session that hold inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


# of the running thread: a stream's batch and a job in the same driver do not see each other's
_open_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("staging", default=())


@contextlib.contextmanager
def staging(spark: SparkSession):
    """Tables staged inside the block are deleted at its end.

    For jobs, which return counts or stored tables. A query that returns a DataFrame over
    staged tables leaves them to the cluster's clean-up of the shared folder.
    """
    paths: list[str] = []
    token = _open_scopes.set((*_open_scopes.get(), paths))
    try:
        yield
    finally:
        _open_scopes.reset(token)
        for path in paths:
            delete_path(spark, path)


def staged(df: DataFrame, name: str, parts: int = 1, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader over the copy.

    Later branches then read columnar, pruned files rather than recompute the input,
    and a lost executor costs a re-read, not the whole lineage. With ``parts`` the rows are written
    in so many turns, dealt out by a hash of column ``by``, where all at once would shuffle too much.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if scopes := _open_scopes.get():
        scopes[-1].append(path)
    for part in range(parts):
        rows = df if parts == 1 else df.where(F.pmod(F.xxhash64(by), F.lit(parts)) == part)
        rows.write.mode("append").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
