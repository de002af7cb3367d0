"""Sinks.

* The report is one CSV file with a header, written by one task: it holds at
  most one row per requested night, so a single partition is the right size.
* Marts are versioned Parquet tables (`staylens.sinks.versioned`), replaced
  atomically and read with `read_table`. Night-grain marts are partitioned by
  month and range-partitioned then sorted by (night, hotel_id) inside each task,
  so files are few per month and row-group statistics prune by night and hotel.
  ``incremental=True`` replaces the nights of the frame in the stored table
  and keeps all others: only months that it touches are written again.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators.kpis import MONTH_COLUMN, REPORT_COLUMNS
from staylens.sinks.versioned import Commit, VersionedTable, by_month

PARTITION_COLUMN = MONTH_COLUMN


def _iso(value) -> str:
    return value.isoformat() if isinstance(value, date) else str(value)


def report_file_name(hotel_id: str, from_date, to_date) -> str:
    """``kpi_<hotel>_<yyyy>_<mm>_<dd>_to_<yyyy>_<mm>_<dd>.csv``"""
    return f"kpi_{hotel_id}_{_iso(from_date).replace('-', '_')}_to_{_iso(to_date).replace('-', '_')}.csv"


def _hadoop_fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def write_report_csv(report: DataFrame, out_dir: str, file_name: str) -> str:
    """Write the report as exactly one CSV file ``out_dir/file_name``.

    Spark writes a folder of part files; the report is first written to a
    unique staging folder next to the target (same file system, any storage
    Hadoop can address) and its single part file is then renamed into place.
    """
    spark = report.sparkSession
    target = f"{out_dir.rstrip('/')}/{file_name}"
    staging = f"{out_dir.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    (report.coalesce(1)
     .sortWithinPartitions(F.col(REPORT_COLUMNS[0]).desc())
     .write.mode("overwrite").option("header", True).csv(staging))
    fs, staging_path = _hadoop_fs(spark, staging)
    parts = [s.getPath() for s in fs.listStatus(staging_path) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {staging}, found {len(parts)}")
    _, target_path = _hadoop_fs(spark, target)
    if fs.exists(target_path):
        fs.delete(target_path, False)
    if not fs.rename(parts[0], target_path):
        raise RuntimeError(f"could not move report into {target}")
    fs.delete(staging_path, True)
    return target


NIGHT_ORDER = ("night", "hotel_id")


def _stage(df: DataFrame, path: str, by_night: bool, incremental: bool) -> tuple[VersionedTable, Commit]:
    stored = VersionedTable(df.sparkSession, path)
    if not by_night:
        return stored, stored.stage(df)
    dated = by_month(df, PARTITION_COLUMN)
    if incremental and stored.commit() is not None:
        return stored, stored.stage_merge(dated, ["hotel_id", "night"], NIGHT_ORDER)
    return stored, stored.stage(dated, PARTITION_COLUMN, NIGHT_ORDER)


def write_table(df: DataFrame, path: str, by_night: bool = False, incremental: bool = False) -> None:
    """Write a mart as a versioned Parquet table; night-grain marts are
    partitioned by month. Readers see the old table until the new one is whole."""
    stored, commit = _stage(df, path, by_night, incremental)
    stored.publish(commit)


def month_filter(from_date, to_date):
    """Partition predicate matching nights in [from_date, to_date]."""
    lo, hi = _iso(from_date)[:7], _iso(to_date)[:7]
    return (F.col(PARTITION_COLUMN) >= lo) & (F.col(PARTITION_COLUMN) <= hi)


# Mart attribute -> (table name, night grain)
MART_TABLES = {
    "fact": ("fct_daily_kpis", True),
    "availability": ("data_availability", True),
    "market_blend": ("mart_kpi_with_market", True),
    "freshness": ("data_freshness", False),
    "reconciliation": ("reconciliation_report", False),
}


def write_marts(marts, out_dir: str, incremental: bool = False,
                only: set[str] | None = None) -> dict[str, str]:
    """Persist the marts (all, or the attributes in ``only``) under
    ``out_dir``; returns table name -> path. All are written before the first
    is made visible, so a failure while writing changes none of them."""
    out = out_dir.rstrip("/")
    paths, staged = {}, []
    for attr, (name, by_night) in MART_TABLES.items():
        if only is not None and attr not in only:
            continue
        paths[name] = f"{out}/{name}"
        staged.append(_stage(getattr(marts, attr), paths[name], by_night, incremental and by_night))
    for stored, commit in staged:
        stored.publish(commit)
    return paths
