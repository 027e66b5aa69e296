"""Parquet tables that change by whole versions.

A version lists the immutable data folders that make up the table. It is published by renaming a
complete folder of the log into place, which either happens or does not: a reader sees the version
before or the one after, and of two writers that build on the same version one has to look again.
That takes a file system whose directory renames are atomic (HDFS, POSIX).

    <path>/commit=c-<id>/<partition folders>/part-*.parquet     data, never changed
    <path>/_versions/v000000000012/commit.json                  version 12

Plain Spark readers ignore the log; for a table that was only appended to they see the same rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspark.operators import fileindex
from tillspark.session import delete_path, list_folder, move_path, path_exists, read_text, write_text

LOG = "_versions"
MAX_RECORDS_PER_FILE = 5_000_000
ATTEMPTS = 50


class CommitConflict(RuntimeError):
    """Another writer changed what this change was computed from."""


@dataclass(frozen=True)
class Version:
    """One state of a table: its data folders, schema and notes; version 0 holds nothing."""

    number: int = 0
    folders: tuple[str, ...] = ()
    schema: StructType | None = None
    notes: dict = field(default_factory=dict)
    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()

    def in_partitions(self, partitions: Iterable[str]) -> list[str]:
        wanted = set(partitions)
        return [f for f in self.folders if partition_of(f) in wanted]


@dataclass(frozen=True)
class Change:
    """Folders to add and remove. ``reads`` names the partitions it was computed from; None means all."""

    add: Sequence[str] = ()
    remove: Sequence[str] = ()
    schema: StructType | None = None
    notes: dict = field(default_factory=dict)
    reads: frozenset[str] | None = None


def partition_of(folder: str) -> str:
    """The partition folders below the commit: '' for an unpartitioned table."""
    return folder.partition("/")[2]


class VersionedTable:
    """A table at ``path``, partitioned by ``partitions``."""

    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ()):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), list(partitions)
        self.log = f"{self.path}/{LOG}"

    # --- versions ----------------------------------------------------------------------

    def _place(self, number: int) -> str:
        return f"{self.log}/v{number:012d}"

    def numbers(self) -> list[int]:
        """Published versions in order."""
        return sorted(int(name[1:]) for name in list_folder(self.spark, self.log) if name.startswith("v"))

    def version(self, number: int | None = None) -> Version:
        """The given version, by default the newest."""
        if number is None:
            number = max(self.numbers(), default=0)
        if number == 0:
            return Version()
        stored = json.loads(read_text(self.spark, f"{self._place(number)}/commit.json"))
        schema = StructType.fromJson(stored["schema"]) if stored["schema"] else None
        lists = (tuple(stored[name]) for name in ("folders", "added", "removed"))
        folders, added, removed = lists
        return Version(number, folders, schema, stored["notes"], added, removed)

    def _publish(self, version: Version) -> bool:
        """Make ``version`` visible; False where its number is taken."""
        token = uuid.uuid4().hex
        draft = f"{self.log}/.draft-{token}"
        document = {
            "token": token,
            "schema": version.schema.jsonValue() if version.schema else None,
            "folders": version.folders,
            "added": version.added,
            "removed": version.removed,
            "notes": version.notes,
        }
        write_text(self.spark, f"{draft}/commit.json", json.dumps(document))
        place = self._place(version.number)
        if not path_exists(self.spark, place):
            # a rename onto a folder that has come into being moves the draft below it, or fails
            try:
                move_path(self.spark, draft, place)
            except OSError:
                pass
        published = json.loads(read_text(self.spark, f"{place}/commit.json"))["token"] == token
        if not published:
            delete_path(self.spark, draft)
            delete_path(self.spark, f"{place}/.draft-{token}")
        return published

    def commit(self, base: Version, change: Change) -> Version:
        """Publish ``change``, computed from ``base``.

        Versions that others published meanwhile are built upon where they touch no partition
        that the change was computed from; otherwise it has to be computed again.
        """
        while True:
            removed = set(change.remove)
            kept = [f for f in base.folders if f not in removed]
            new = Version(
                base.number + 1, (*kept, *change.add), change.schema or base.schema,
                {**base.notes, **change.notes}, tuple(change.add), tuple(change.remove),
            )
            if self._publish(new):
                return new
            base = self.version(new.number)
            touched = {partition_of(f) for f in (*base.added, *base.removed)}
            if change.reads is None or touched & change.reads:
                raise CommitConflict(f"{self.path}: version {base.number} changed what this load read")

    def update(self, build: Callable[[Version], Change | None]) -> Version:
        """Compute a change from the newest version and publish it, again if another load came first.

        ``build`` returns None where there is nothing to change.
        """
        for _ in range(ATTEMPTS):
            base = self.version()
            change = build(base)
            if change is None:
                return base
            try:
                return self.commit(base, change)
            except CommitConflict:
                for folder in change.add:
                    delete_path(self.spark, f"{self.path}/{folder}")
        raise CommitConflict(f"{self.path}: gave way to other loads {ATTEMPTS} times")

    # --- data --------------------------------------------------------------------------

    def read(
        self, version: Version | None = None, folders: Sequence[str] | None = None, files: bool = False
    ) -> DataFrame:
        """The table at a version (the newest), or the given folders or files of it.

        With ``files`` a column ``_file`` tells the file of each row, as Spark names it.
        """
        version = version or self.version()
        if version.schema is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        folders = version.folders if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        reader = self.spark.read.schema(version.schema).option("basePath", self.path)
        rows = reader.parquet(*[f"{self.path}/{f}" for f in folders])
        file = [F.col("_metadata.file_path").alias(fileindex.FILE)] if files else []
        return rows.select(*version.schema.names, *file)

    def added_since(self, number: int) -> tuple[Version, list[str] | None]:
        """The newest version, and the folders added after version ``number``.

        None in their place where something was removed, so that additions do not tell all.
        """
        newest, added = self.version(), []
        for n in range(number + 1, newest.number + 1):
            step = self.version(n)
            if step.removed:
                return newest, None
            added += step.added
        return newest, added

    def write(
        self, df: DataFrame, cluster: Sequence[str] = (), sought: Sequence[str] = (), spread: bool = True, **options: object
    ) -> tuple[list[str], int]:
        """Write rows as new folders that no version lists yet; returns them and the rows written.

        Rows of a partition meet in few files and a busy partition is split over tasks. With
        ``cluster`` the files of a partition hold ranges of these columns, in order. Without ``spread``
        no row is shuffled: each task writes its own rows, in order of ``cluster``. Files carry
        Parquet's own Bloom filters for the columns in ``sought``, by which a search for one value
        skips row groups. Other ``options`` go to the Parquet writer.
        """
        commit, written = f"commit=c-{uuid.uuid4().hex}", Observation()
        if not spread:
            laid_out = df
        elif cluster:
            laid_out = df.repartitionByRange(*self.partitions, *cluster)
        else:
            laid_out = df.hint("rebalance", *self.partitions) if self.partitions else df
        # above the shuffle, in the stage that writes: there a repeated task cannot count twice
        counted = laid_out.observe(written, F.count(F.lit(1)).alias("rows"))
        if cluster:
            counted = counted.sortWithinPartitions(*self.partitions, *cluster)
        writer = counted.write.option("compression", "snappy").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in sought}
        writer = writer.options(**filters, **options)
        writer.partitionBy(*self.partitions).parquet(f"{self.path}/{commit}")
        folders = [commit]
        for _ in self.partitions:
            folders = [f"{f}/{n}" for f in folders for n in list_folder(self.spark, f"{self.path}/{f}") if "=" in n]
        return folders, written.get["rows"]

    def append(self, df: DataFrame, notes: dict | None = None, cluster: Sequence[str] = ()) -> int:
        """Add rows; nothing that others do meanwhile is in the way. Returns the rows written."""
        folders, rows = self.write(df, cluster)
        self.update(lambda base: Change(folders, (), base.schema or df.schema, notes or {}, frozenset()))
        return rows

    def replace(self, build: Callable[[Version], DataFrame], notes: dict | None = None) -> DataFrame:
        """Replace the whole table by what ``build`` makes of the newest version."""

        def change(base: Version) -> Change:
            df = build(base)
            folders, _ = self.write(df)
            return Change(folders, base.folders, df.schema, notes or {})

        return self.read(self.update(change))

    def replace_partitions(
        self, build: Callable[[Version], DataFrame], touched: Iterable[str] = ()
    ) -> DataFrame:
        """Replace the partitions that ``build`` makes rows for, and those named in ``touched``."""

        def change(base: Version) -> Change:
            df = build(base)
            folders, _ = self.write(df)
            reads = frozenset(touched) | {partition_of(f) for f in folders}
            return Change(folders, base.in_partitions(reads), base.schema or df.schema, {}, reads)

        return self.read(self.update(change))

    def vacuum(self, keep: int = 2, older_than_s: float = 7 * 24 * 3600) -> list[str]:
        """Delete versions before the newest ``keep`` and data folders that none of these list.

        Folders younger than ``older_than_s`` stay: they may belong to a load under way, or to
        a reader of an older version.
        """
        numbers = self.numbers()
        live = {f.partition("/")[0] for n in numbers[-keep:] for f in self.version(n).folders}
        names = list_folder(self.spark, self.path, older_than_s)
        doomed = [n for n in names if n.startswith("commit=") and n not in live]
        for number in numbers[:-keep]:
            delete_path(self.spark, self._place(number))
        for name in doomed:
            delete_path(self.spark, f"{self.path}/{name}")
        return doomed


def _below_table(file: Column) -> Column:
    """A file's path below its table, from the URI by which Spark names it."""
    # a plus sign stands for itself
    place = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(place, "(commit=c-[^/]*/.*)$", 1)


class _FileIndex:
    """An index of a table's files, kept beside the data: a folder per commit.

    It is written before the commit is published, so every listed folder has its index.
    Folders of commits without one are always read.
    """

    def __init__(self, table: VersionedTable, columns: Sequence[str], kind: str):
        self.table, self.columns = table, list(columns)
        self.path = f"{table.path}/_{kind}_{'_'.join(columns)}"

    def _rows(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def add(self, folders: Sequence[str], schema: StructType) -> None:
        """Index newly written folders; only the indexed columns are read back."""
        if folders:
            rows = self.table.read(Version(schema=schema), folders, files=True)
            # once per index row: for each row of the table it would cost more than the index
            index = self._rows(rows).withColumn(fileindex.FILE, _below_table(F.col(fileindex.FILE)))
            index.write.parquet(f"{self.path}/{folders[0].partition('/')[0]}")

    def refresh(self) -> list[str]:
        """Index the folders of the newest version that have no index yet; returns their commits."""
        version = self.table.version()
        indexed = set(list_folder(self.table.spark, self.path))
        missing: dict[str, list[str]] = {}
        for folder in version.folders:
            if (commit := folder.partition("/")[0]) not in indexed:
                missing.setdefault(commit, []).append(folder)
        for folders in missing.values():
            self.add(folders, version.schema)
        return sorted(missing)

    def _read(self, version: Version, folders: Sequence[str], find: Callable[[DataFrame], DataFrame | None]) -> DataFrame:
        """Rows of the files in ``folders`` that ``find`` names from their index.

        The list of files goes through the driver, which lists them anyway to read them.
        """
        commits = {f.partition("/")[0] for f in folders}
        indexed = commits & set(list_folder(self.table.spark, self.path))
        files = [f for f in folders if f.partition("/")[0] not in indexed]
        if indexed:
            found = find(self.table.spark.read.parquet(*[f"{self.path}/{c}" for c in sorted(indexed)]))
            if found is None:
                return self.table.read(version, folders)
            wanted = set(folders)
            files += [r[0] for r in found.collect() if r[0].rpartition("/")[0] in wanted]
        return self.table.read(version, sorted(files))


class KeyIndex(_FileIndex):
    """Key ranges and filters, for loads that look for stored keys."""

    def __init__(self, table: VersionedTable, keys: Sequence[str]):
        super().__init__(table, keys, "index")

    def _rows(self, rows: DataFrame) -> DataFrame:
        partitions = [p for p in self.table.partitions if p not in self.columns]
        return fileindex.index_rows(rows.select(fileindex.FILE, *self.columns, *partitions), self.columns, self.table.partitions)

    def matching(self, version: Version, folders: Sequence[str], batch: DataFrame) -> DataFrame:
        """Rows of those files in ``folders`` that may hold a key of ``batch``."""

        def find(index: DataFrame) -> DataFrame:
            return fileindex.files_that_may_hold(index, batch, self.columns, self.table.partitions)

        return self._read(version, folders, find)


class TextIndex(_FileIndex):
    """Trigram filters of text columns, for searches of a part of a text."""

    def __init__(self, table: VersionedTable, columns: Sequence[str]):
        super().__init__(table, columns, "trigrams")

    def _rows(self, rows: DataFrame) -> DataFrame:
        return fileindex.text_index_rows(rows, self.columns)

    def containing(self, version: Version, term: str) -> DataFrame:
        """Rows of those files that may hold ``term`` in one of the columns."""
        return self._read(version, version.folders, lambda index: fileindex.files_that_may_contain(index, self.columns, term))


def is_versioned(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/{LOG}")
