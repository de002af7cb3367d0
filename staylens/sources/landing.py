"""Landing: write raw feeds once as all-text Parquet, then read them back.

Raw PMS files (enveloped JSON, CSV) are expensive to parse and an enveloped
JSON document is a single task. Landing them once into Parquet, still with
every leaf as text, gives splittable, column-pruned input to every model that
reads the feeds, as a landing zone does. The landing folder must be shared
storage on a cluster; by default it lives under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
import uuid
import warnings
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from staylens.operators.kpis import MONTH_COLUMN
from staylens.session import ensure_checkpoint_dir


def landing_root(spark: SparkSession, key: str) -> str:
    """A landing folder for one input set in this application."""
    tag = hashlib.sha1(key.encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing/{spark.sparkContext.applicationId}/{tag}"


#: Bytes of a landed feed that one task sorts, and of the row groups it is cut
#: at: nested text takes some ten times as much in memory, and a task that sorts
#: the usual 128 MB of it would spill all its rows.
SORTED_BYTES = 32 << 20


@contextmanager
def small_splits(spark: SparkSession):
    """Files read meanwhile are split at `SORTED_BYTES`, or less where the
    session says so."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    jvm = spark.sparkContext._jvm
    spark.conf.set(key, min(SORTED_BYTES, jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that run meanwhile delete their shuffle files when they end;
    otherwise these stay until the driver's garbage collector finds them. For
    plans that are run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: For intermediate tables of nested text, which are a third smaller than usual with it.
COMPACT = {"compression": "zstd"}


def write_table(df: DataFrame, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return a reader of it."""
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_month(df: DataFrame, path: str) -> DataFrame:
    """Write a night-grain table partitioned by month, clustered by (hotel_id,
    night) inside a month, and return a reader of it."""
    month = df.withColumn(MONTH_COLUMN, F.date_format("night", "yyyy-MM"))
    clustered = month.repartitionByRange(MONTH_COLUMN, "hotel_id", "night").sortWithinPartitions(MONTH_COLUMN, "hotel_id", "night")
    clustered.write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(path)
    return df.sparkSession.read.schema(month.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own tables, with the catalog entries
    of those that are bucketed."""
    for t in spark.catalog.listTables():
        if t.name.startswith("staylens_") and not t.isTemporary:
            where = spark.sql(f"DESCRIBE FORMATTED `{t.name}`").filter("col_name = 'Location'").first()
            if where and path in where["data_type"]:
                spark.sql(f"DROP TABLE `{t.name}`")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_bucketed(df: DataFrame, root: str, label: str, keys: list[str],
                   sort: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table bucketed by ``keys`` under ``root`` and
    return a reader of it.

    The bucket count is the session's shuffle partition count. When ``df`` was
    just hash-partitioned on the same keys (an aggregate or a rank on them),
    each bucket is written by one task, so there is one file per bucket. A
    read of the table then reports that hash partitioning, so joins,
    aggregates and ranks on the keys (or on a superset) need no shuffle.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"staylens_{label}_{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write.bucketBy(n, *keys)
    if sort:
        writer = writer.sortBy(*keys)
    try:
        writer.option("path", path).mode("overwrite").saveAsTable(name)
    except AnalysisException as exc:
        # The catalog cannot hold the table. Keep the data as plain Parquet:
        # results are the same, only the co-location is lost. A failure of the
        # write itself is no AnalysisException and is raised.
        warnings.warn(f"bucketed table {name} not written ({exc.getCondition()}); using plain Parquet")
        return write_table(df, path + "-plain")
    return spark.table(name)


def land_counted(feeds: dict[str, DataFrame], root: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write every feed to ``root/<source>`` (Parquet) and return readers of
    the landed copies and their row counts. The schema (all text, nested lists
    kept) is unchanged. The rows are counted while they are written, without a
    job of their own. The feeds are independent jobs and are submitted
    concurrently."""
    def one(source: str, df: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation(f"landed-{source}")
        copy = write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root.rstrip('/')}/{source}", {"parquet.block.size": str(SORTED_BYTES)} | COMPACT)
        return copy, seen.get["rows"]

    with ThreadPoolExecutor(max_workers=len(feeds)) as pool:
        futures = {s: pool.submit(one, s, df) for s, df in feeds.items()}
        done = {s: f.result() for s, f in futures.items()}
    return {s: d[0] for s, d in done.items()}, {s: d[1] for s, d in done.items()}


def land(feeds: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """`land_counted` without the counts."""
    return land_counted(feeds, root)[0]
