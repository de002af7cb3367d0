"""Mart tables are replaced atomically: readers see a whole write or none."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from staylens.sinks import CommitConflict, VersionedTable, files, read_table, write_table

SCHEMA = "hotel_id string, night date, rooms long"


def nights(spark, *rows):
    return spark.createDataFrame([(h, dt.date.fromisoformat(n), r) for h, n, r in rows], SCHEMA)


def content(df):
    return sorted((r["hotel_id"], str(r["night"]), r["rooms"]) for r in df.collect())


OLD = [("H", "2031-01-30", 1), ("H", "2031-02-01", 2), ("G", "2031-02-02", 3)]


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "fact")
    write_table(nights(spark, *OLD), path, by_night=True)
    return path


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def _broken(spark, n):
    """Rows of which the last partition fails, after the others were written."""
    row = F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("disk full")).cast("long"))
    return spark.range(n, numPartitions=n).select(F.lit("H").alias("hotel_id"), F.date_add(F.lit(dt.date(2031, 2, 1)), F.col("id").cast("int")).alias("night"), row.alias("rooms"))


@pytest.mark.parametrize("incremental", [False, True])
def test_a_write_that_fails_midway_changes_nothing(spark, path, incremental):
    with pytest.raises(Exception, match="disk full"):
        write_table(_broken(spark, 5), path, by_night=True, incremental=incremental)
    assert content(read_table(spark, path)) == sorted(OLD)
    # nor does one that has written all its files and fails before its commit
    stored = VersionedTable(spark, path)
    stored.stage(files.by_month(nights(spark, ("X", "2031-02-01", 9)), "night_month"), "night_month")
    assert len(_files(path)) > 2 and content(read_table(spark, path)) == sorted(OLD)
    write_table(nights(spark, ("H", "2031-02-01", 7)), path, by_night=True, incremental=True)
    assert content(read_table(spark, path)) == sorted([OLD[0], ("H", "2031-02-01", 7), OLD[2]])
    assert stored.vacuum() and content(read_table(spark, path)) == sorted([OLD[0], ("H", "2031-02-01", 7), OLD[2]])


def test_a_reader_that_has_begun_keeps_its_version(spark, path):
    before = read_table(spark, path)
    write_table(nights(spark, ("X", "2031-05-01", 9)), path, by_night=True)
    assert content(before) == sorted(OLD)
    assert content(read_table(spark, path)) == [("X", "2031-05-01", 9)]
    assert content(read_table(spark, path, 1)) == sorted(OLD)


def test_other_months_are_neither_read_nor_written(spark, path):
    january = {f: t for f, t in _files(path).items() if "2031-01" in f}
    folders = VersionedTable(spark, path).commit().folders
    write_table(nights(spark, ("H", "2031-02-01", 7), ("H", "2031-03-01", 8)), path, by_night=True, incremental=True)
    now = VersionedTable(spark, path).commit().folders
    assert now["2031-01"] == folders["2031-01"] and now["2031-02"] != folders["2031-02"] and "2031-03" in now
    assert january.items() <= _files(path).items()
    VersionedTable(spark, path).vacuum()
    assert january.items() <= _files(path).items()
    assert content(read_table(spark, path)) == sorted([OLD[0], ("H", "2031-02-01", 7), OLD[2], ("H", "2031-03-01", 8)])


def test_of_two_writers_one_fails(spark, path):
    stored = VersionedTable(spark, path)
    mine = stored.stage_merge(files.by_month(nights(spark, ("H", "2031-02-01", 7)), "night_month"), ["hotel_id", "night"])
    write_table(nights(spark, ("H", "2031-02-01", 5)), path, by_night=True, incremental=True)
    with pytest.raises(CommitConflict):
        stored.publish(mine)
    assert ("H", "2031-02-01", 5) in content(read_table(spark, path))
    assert not [f for f in os.listdir(f"{path}/_commits") if "draft" in f and not f.endswith(".crc")]


def test_months_can_be_replaced_and_end(spark, path):
    stored = VersionedTable(spark, path)
    frame = files.by_month(nights(spark, ("N", "2031-02-09", 4)), "night_month")
    with pytest.raises(ValueError, match="not replaced"):
        stored.replace_partitions(frame, ["2031-01"])
    stored.replace_partitions(frame, ["2031-01", "2031-02"])
    assert content(stored.read()) == [("N", "2031-02-09", 4)]
    stored.replace_partitions(frame.limit(0), ["2031-02"])
    assert stored.read().collect() == [] and stored.read().columns == ["hotel_id", "night", "rooms", "night_month"]


def test_plain_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "plain")
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    write_table(nights(spark), path)
    assert read_table(spark, path).collect() == []
    write_table(nights(spark, *OLD), path)
    assert content(read_table(spark, path)) == sorted(OLD)
    write_table(nights(spark), f"{path}-n", by_night=True)
    assert read_table(spark, f"{path}-n").isEmpty()
    write_table(nights(spark, *OLD), f"{path}-n", by_night=True, incremental=True)
    assert content(read_table(spark, f"{path}-n")) == sorted(OLD)


def test_marts_become_visible_together(spark, tmp_path, write_json, monkeypatch):
    from staylens.plans.marts import Marts
    from staylens.sources import read_native

    from helpers import ROOMS, inventory, lodge_events
    out = str(tmp_path / "marts")
    m = Marts(feeds={"native": read_native(spark, write_json("n.json", {"data": lodge_events()}))}, inventory_raw=inventory(spark, ROOMS))
    only = {"fact", "availability", "reconciliation"}
    files.write_marts(m, out, only=only)
    before = {t: read_table(spark, f"{out}/{t}").collect() for t in os.listdir(out)}
    again = Marts(feeds={"native": read_native(spark, write_json("m.json", {"data": lodge_events()[:1]}))}, inventory_raw=inventory(spark, ROOMS))
    monkeypatch.setattr(Marts, "reconciliation", property(lambda self: _broken(spark, 3)))
    with pytest.raises(Exception, match="disk full"):
        files.write_marts(again, out, only=only)
    assert len(before) == 3 and {t: read_table(spark, f"{out}/{t}").collect() for t in os.listdir(out)} == before
