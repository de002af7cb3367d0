"""Tables that are replaced atomically.

A table is a folder of immutable versions and a list of commits:

    <table>/version=<id>/[<partition>=<value>/]part-*.parquet
    <table>/_commits/00000007.json

A writer puts its files into a version folder of its own, which nobody reads
yet, and then adds one commit file that names the folder of every partition.
Readers resolve the commit with the highest number, so they see all of a write
or nothing of it; a writer that fails leaves the table as it was. A commit is a
file renamed to a number that must be free, so of two writers that started from
the same commit one fails with `CommitConflict` and can write again.

A write that replaces some partitions names the folders of the others as they
are: their files are neither read nor copied.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_COLUMN = "version"
_COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class CommitLog:
    """Numbered commit files, JSON objects, below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._new_path(self.path).getFileSystem(self._conf)

    def hadoop_path(self, relative: str = ""):
        return self._new_path(f"{self.path}/{relative}" if relative else self.path)

    def _file(self, number: int):
        return self.hadoop_path(f"{_COMMITS}/{number:08d}.json")

    def numbers(self) -> list[int]:
        folder = self.hadoop_path(_COMMITS)
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._file(number))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def publish(self, number: int, content: dict) -> None:
        """Add a commit, all at once; `CommitConflict` if the number is taken."""
        jvm = self.spark.sparkContext._jvm
        draft = self.hadoop_path(f"{_COMMITS}/.draft-{uuid.uuid4().hex}")
        out = self.fs.create(draft, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(self._file(number)), options)
        except Py4JJavaError as exc:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(exc.java_exception.getClass().getName()):
                raise CommitConflict(f"{self.path} has commit {number} of another writer") from exc
            raise

    def forget(self, number: int) -> None:
        self.fs.delete(self._file(number), False)


@dataclass(frozen=True)
class Commit:
    """What a table holds: its schema, its partition column (or None) and the
    folder of each partition value (of the whole table under "")."""

    number: int
    schema: T.StructType
    partition: str | None
    folders: dict[str, str]

    def content(self) -> dict:
        return {"schema": self.schema.jsonValue(), "partition": self.partition, "folders": self.folders}

    @classmethod
    def of(cls, number: int, content: dict) -> Commit:
        return cls(number, T.StructType.fromJson(content["schema"]), content["partition"], content["folders"])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, path)

    def commit(self, number: int | None = None) -> Commit | None:
        """The commit of that number, by default the current one; None before the first."""
        if number is None:
            numbers = self.log.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        return Commit.of(number, self.log.read(number))

    def publish(self, commit: Commit) -> Commit:
        self.log.publish(commit.number, commit.content())
        return commit

    # --- reading ------------------------------------------------------------
    def read(self, number: int | None = None) -> DataFrame:
        """The table as of a commit, by default the current one."""
        commit = self.commit(number)
        if commit is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self.read_folders(commit, commit.folders.values())

    def read_folders(self, commit: Commit, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.path}/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], commit.schema)
        schema = T.StructType([*commit.schema.fields, T.StructField(VERSION_COLUMN, T.StringType())])
        return (self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
                .select(*commit.schema.names))

    # --- writing ------------------------------------------------------------
    def _write(self, df: DataFrame, version: str, partition: str | None, order: Sequence[str]) -> None:
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*([partition] if partition else []), *order)
        writer = df.write.mode("append")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{self.path}/{VERSION_COLUMN}={version}")

    def _folders(self, version: str, partition: str | None) -> dict[str, str]:
        root = f"{VERSION_COLUMN}={version}"
        if partition is None:
            return {"": root}
        found = self.log.fs.globStatus(self.log.hadoop_path(f"{root}/{partition}=*"))
        unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        names = [s.getPath().getName() for s in found or []]
        return {unescape(n.partition("=")[2]): f"{root}/{n}" for n in names}

    @staticmethod
    def _fields(df: DataFrame, partition: str | None) -> T.StructType:
        own = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name != partition]
        return T.StructType(own + ([T.StructField(partition, T.StringType())] if partition else []))

    def stage(self, df: DataFrame, partition: str | None = None, order: Sequence[str] = (), now: Commit | None = None) -> Commit:
        """Write ``df`` as a version that nobody reads yet; `publish` makes it
        the whole table. ``now`` is the commit it follows, by default the current."""
        now, version = now or self.commit(), uuid.uuid4().hex
        self._write(df, version, partition, order)
        return Commit(now.number + 1 if now else 1, self._fields(df, partition), partition, self._folders(version, partition))

    def replace(self, df: DataFrame, partition: str | None = None, order: Sequence[str] = ()) -> Commit:
        """Make ``df`` the whole table."""
        return self.publish(self.stage(df, partition, order))

    def stage_partitions(self, df: DataFrame, values: Iterable[str], order: Sequence[str] = (), now: Commit | None = None) -> Commit:
        """Stage ``df`` as the whole content of the partitions ``values``: those
        without a row end, all others stay as they are."""
        now = now or self._existing(df)
        version = uuid.uuid4().hex
        self._write(df.select(*now.schema.names), version, now.partition, order)
        new, values = self._folders(version, now.partition), set(values)
        if not set(new) <= values:
            raise ValueError(f"rows of partitions that are not replaced: {sorted(set(new) - values)}")
        return Commit(now.number + 1, now.schema, now.partition, {k: v for k, v in now.folders.items() if k not in values} | new)

    def replace_partitions(self, df: DataFrame, values: Iterable[str], order: Sequence[str] = ()) -> Commit:
        return self.publish(self.stage_partitions(df, values, order))

    def stage_merge(self, df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> Commit:
        """Stage the rows of ``df`` in place of those with the same ``keys``.
        Only partitions that ``df`` has rows of are read and written again; a
        key must determine its partition."""
        now = self._existing(df)
        version = uuid.uuid4().hex
        self._write(df.select(*now.schema.names), version, now.partition, order)
        new = self._folders(version, now.partition)
        staged = Commit(now.number + 1, now.schema, now.partition, new)
        touched = [f for value, f in now.folders.items() if value in new]
        if touched:
            given = self.read_folders(staged, list(new.values())).select(*keys).distinct()
            rest = self.read_folders(now, touched).join(given, list(keys), "left_anti").select(*now.schema.names)
            self._write(rest, version, now.partition, order)
        return Commit(now.number + 1, now.schema, now.partition, now.folders | new)

    def merge(self, df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> Commit:
        return self.publish(self.stage_merge(df, keys, order))

    def _existing(self, df: DataFrame) -> Commit:
        now = self.commit()
        if now is None or now.partition is None:
            raise ValueError(f"{self.path} is no partitioned table yet")
        if sorted(df.columns) != sorted(now.schema.names):
            raise ValueError(f"columns {df.columns} do not fit the table's {now.schema.names}")
        return now

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the folders that none of the last ``keep`` commits names, and
        the commits before those; returns the versions that went whole. Not to
        be run while a writer works or a reader holds an older commit."""
        numbers = self.log.numbers()
        kept = {f for n in numbers[-keep:] for f in self.commit(n).folders.values()}
        gone = drop_versions(self.log, self.log.hadoop_path(), kept)
        for n in numbers[:-keep]:
            self.log.forget(n)
        return gone


def drop_versions(log: CommitLog, folder, kept: set[str]) -> list[str]:
    """Delete the version folders below ``folder`` that are not ``kept``, whole
    or by partition."""
    versions = {f.split("/")[0] for f in kept}
    gone = []
    for status in log.fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith(f"{VERSION_COLUMN}="):
            continue
        if name not in versions:
            log.fs.delete(status.getPath(), True)
            gone.append(name)
        elif name not in kept:
            for part in log.fs.listStatus(status.getPath()):
                if part.isDirectory() and f"{name}/{part.getPath().getName()}" not in kept:
                    log.fs.delete(part.getPath(), True)
    return gone


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table at ``path`` as of a commit, by default the current one."""
    return VersionedTable(spark, path).read(number)


def by_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format("night", "yyyy-MM"))
