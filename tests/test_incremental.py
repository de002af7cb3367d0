"""A store that is kept up batch by batch equals a full rebuild."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from staylens.operators import dimensions, kpis
from staylens.plans.incremental import KEY, MartStore, merge_latest
from staylens.plans.marts import Marts
from staylens.schemas import NATIVE_EVENT, NORDIC_ROW

from helpers import LODGE, ROOMS, booking, inventory
from test_versioned import _files
from test_plans import plan_of


def _native(rng, n, keys=12):
    out = []
    for _ in range(n):
        a = rng.randint(1, 26)
        z = a + rng.randint(0, 3)
        e = booking(f"r{rng.randint(0, keys)}", [(rng.choice(["QN", "TW", "XX"]), a, rng.randint(a, 29), rng.choice(["7.5", "80", "n/a"])) for _ in range(rng.randint(0, 2))],
                    (a, z), rng.choice(["confirmed", "cancelled", "checked_out", "odd"]), f"2031-02-{rng.randint(1, 28):02d} 10:00:00")
        for k in ("arrival_date", "departure_date"):
            e[k] = e[k].replace("2031-03", f"2031-{rng.choice(['03', '03', '04'])}")
        out.append(e)
    return out


def _nordic(rng, n, keys=12):
    rows = []
    for _ in range(n):
        a = dt.date(2031, 5, 1) + dt.timedelta(rng.randint(0, 40))
        night = a + dt.timedelta(rng.randint(-1, 3))
        text = lambda d: f"{d:%d.%m.%Y}"
        rows.append((LODGE, rng.choice(["", f"r{rng.randint(0, keys)}", f"n{rng.randint(0, keys)}"]) or None, rng.choice(["OK", "CXL", "OUT", "bad"]), text(a), text(a + dt.timedelta(3)),
                     text(night), rng.choice(["QN", "TW", "XX"]), "EUR", str(rng.randint(10, 99)), "1", rng.choice(["", "17.30", "5"])))
    return rows


def _feeds(spark, native, nordic):
    return {"native": spark.createDataFrame(native, NATIVE_EVENT), "nordic": spark.createDataFrame(nordic, NORDIC_ROW)}


def _capacity(rooms):
    return dimensions.hotel_capacity(rooms)


def _fact(df):
    return sorted(map(str, df.select(*kpis.FACT_COLUMNS, kpis.EXACT_COLUMN).collect()))


def _kept(df):
    return sorted(str(tuple(r[c] for c in ("source_system", *KEY, "status", "arrival_date", "departure_date", "updated_at", "n_items", "items_md5"))) for r in df.collect())


def test_batches_equal_a_full_rebuild(spark, tmp_path):
    rng = random.Random(11)
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    assert store.kept().isEmpty() and store.cells().isEmpty()
    native, nordic, old = [], [], None
    for size in (60, 25, 9, 3):
        a, b = _native(rng, size), _nordic(rng, size)
        native, nordic = native + a, nordic + b
        applied = store.apply(_feeds(spark, a, b))
        full = Marts(feeds=_feeds(spark, native, nordic), inventory_raw=inventory(spark, ROOMS))
        assert _kept(store.kept()) == _kept(full.kept)
        assert _fact(store.fact(_capacity(rooms))) == _fact(full.fact)
        if old is not None:  # an earlier commit still reads as it did
            assert _fact(store.fact(_capacity(rooms), applied.number - 1)) == old
        old = _fact(full.fact)
    # nothing new: nothing is written
    applied = store.apply(_feeds(spark, a, []))
    assert applied.months == () and _fact(store.fact(_capacity(rooms))) == old
    store.vacuum()
    assert _fact(store.fact(_capacity(rooms))) == old and _kept(store.kept()) == _kept(full.kept)
    store.close()
    # another session of the store finds what this one left
    again = MartStore(spark, str(tmp_path / "store"), rooms)
    assert _kept(again.kept()) == _kept(full.kept)
    again.close()


def test_other_months_keep_their_files(spark, tmp_path):
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    march, april = booking("a", [("QN", 10, 11, "7")], (10, 12)), booking("b", [("QN", "2031-04-02", "2031-04-02", "9")])
    april |= {"arrival_date": "2031-04-02", "departure_date": "2031-04-03"}
    assert store.apply({"native": spark.createDataFrame([march, april], NATIVE_EVENT)}).months == ("2031-03", "2031-04")
    before = _files(tmp_path / "store" / "cells")
    late = march | {"updated_at": "2031-02-21 00:00:00", "stay_dates": march["stay_dates"][:0] + booking("a", [("QN", 10, 10, "8")])["stay_dates"]}
    assert store.apply({"native": spark.createDataFrame([late], NATIVE_EVENT)}).months == ("2031-03",)
    after = _files(tmp_path / "store" / "cells")
    assert {f: t for f, t in before.items() if "2031-04" in f}.items() <= after.items()
    assert not [f for f in set(after) - set(before) if "2031-04" in f]
    assert {(str(r["night"]), r["occupied_rooms"], float(r["revenue"])) for r in store.cells().collect()} == {("2031-03-10", 1, 8.0), ("2031-04-02", 1, 9.0)}
    # called off: the night stays with its revenue and no room; then moved away: the cell ends
    store.apply({"native": spark.createDataFrame([late | {"updated_at": "2031-02-22 00:00:00", "status": "cancelled"}], NATIVE_EVENT)})
    assert {(str(r["night"]), r["occupied_rooms"]) for r in store.cells().collect()} == {("2031-03-10", 0), ("2031-04-02", 1)}
    store.apply({"native": spark.createDataFrame([late | {"updated_at": "2031-02-23 00:00:00", "stay_dates": booking("a", [("ATTIC", 10, 10, "8")])["stay_dates"]}], NATIVE_EVENT)})
    assert {str(r["night"]) for r in store.cells().collect()} == {"2031-04-02"}
    assert not os.path.exists(tmp_path / "store" / "latest" / "_temporary")
    store.close()


def test_a_late_snapshot_that_loses_changes_nothing(spark, tmp_path):
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    now = booking("a", [("QN", 10, 11, "7")], sent="2031-02-20 11:15:00")
    store.apply({"native": spark.createDataFrame([now], NATIVE_EVENT)})
    late = booking("a", [("TW", 10, 11, "99")], sent="2031-01-01 11:15:00")
    assert store.apply({"native": spark.createDataFrame([late], NATIVE_EVENT)}).months == ()
    assert store.kept().first()["updated_at"] == dt.datetime(2031, 2, 20, 11, 15)
    store.close()


def test_history_is_not_exchanged(spark, tmp_path):
    """Only the batch is dealt to the buckets; stored snapshots are read in place."""
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    store.apply({"native": spark.createDataFrame([booking(f"r{i}", [("QN", 10, 11, "7")]) for i in range(50)], NATIVE_EVENT)})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        number, state = store._state()
        changes = Marts(feeds={"native": spark.createDataFrame([booking("r1", [("QN", 10, 11, "8")])], NATIVE_EVENT)}, inventory_raw=inventory(spark, ROOMS)).unified
        plan = plan_of(merge_latest(store._latest(state), changes)).splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        scans = [i for i, line in enumerate(plan) if "FileScan parquet" in line and "staylens_store" in line]
        assert len(scans) == 2 and all("Bucketed: true" in plan[i] for i in scans)
        for i in scans:
            level = depth(plan[i])
            for line in reversed(plan[:i]):
                if depth(line) < level:
                    level = depth(line)
                    assert "Exchange" not in line, line
        assert any("Exchange hashpartitioning" in line for line in plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        store.close()


def test_a_batch_counts_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    store.apply({"native": spark.createDataFrame([booking("a", [("QN", 10, 11, "7")])], NATIVE_EVENT)})
    before = _kept(store.kept()), sorted(map(str, store.cells().collect()))
    batch = {"native": spark.createDataFrame([booking("b", [("QN", 10, 11, "7")])], NATIVE_EVENT)}
    with monkeypatch.context() as m:
        m.setattr(MartStore, "_stage_flat", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            store.apply(batch)
    assert (_kept(store.kept()), sorted(map(str, store.cells().collect()))) == before
    store.apply(batch)
    assert store.cells().filter("n_rows = 2").count() == 2
    store.close()


def test_another_inventory_asks_for_a_rebuild(spark, tmp_path):
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    event = {"native": spark.createDataFrame([booking("a", [("ATTIC", 10, 11, "7")]), booking("b", [("QN", 10, 10, "7")])], NATIVE_EVENT)}
    store.apply(event)
    store.close()
    more = MartStore(spark, str(tmp_path / "store"), dimensions.clean_inventory(inventory(spark, [*ROOMS, (LODGE, "ATTIC", 1)])))
    with pytest.raises(ValueError, match="rebuild"):
        more.apply(event)
    assert more.rebuild().months == ("2031-03",)
    assert {(r["night"].day, r["n_rows"]) for r in more.cells().collect()} == {(10, 2), (11, 1)}
    assert more.apply(event).months == ()
    more.close()


def test_a_bucket_gets_one_file_of_new_reservations(spark, tmp_path):
    """However many tasks a batch comes in."""
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for batch in range(2):
            events = [booking(f"r{batch}-{i}", [("QN", 10, 11, "7")], (10, 12)) for i in range(200)]
            store.apply({"native": spark.createDataFrame(events, NATIVE_EVENT).repartition(12)})
            folder = tmp_path / "store" / "latest" / store._state()[1]["latest"]["folder"]
            assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= (batch + 1) * parts
        assert store.kept().count() == 400
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    store.close()


def test_a_batch_is_ranked_before_it_is_fingerprinted(spark, tmp_path):
    """Of a batch's snapshots only those of the latest instant get a
    fingerprint, and what is kept is what the whole order keeps."""
    from pyspark.sql import Window

    from staylens.operators import adapters, reservations
    from staylens.plans.incremental import SOURCE_KEY
    rng = random.Random(5)
    feeds = _feeds(spark, [e | {"updated_at": f"2031-02-0{rng.randint(1, 3)} 10:00:00"} for e in _native(rng, 120)], _nordic(rng, 5))
    store = MartStore(spark, str(tmp_path / "store"), dimensions.clean_inventory(inventory(spark, ROOMS)))
    flat = spark.createDataFrame([], store._flat_schema)
    plan = plan_of(store._changes(feeds, flat, flat), "extended")
    plan = plan[plan.index("Physical Plan"):]
    assert plan.index("row_number(") < plan.index("aggregate(") < plan.index("rank(updated_instant")  # read from its end
    whole = Window.partitionBy(*SOURCE_KEY).orderBy(*reservations.snapshot_order())
    unified = adapters.unified_feed({"native": feeds["native"]})
    want = unified.where("is_valid").withColumn("_rn", F.row_number().over(whole)).where("_rn = 1").drop("_rn")
    got = reservations.latest_snapshots(adapters.unified_feed({"native": feeds["native"]}, fingerprint=False), SOURCE_KEY).select(*want.columns)
    assert got.count() > 5 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def test_a_batch_leaves_what_is_read_of_it(spark, tmp_path):
    """No shuffle files, and after a vacuum one version of the snapshots."""
    rng = random.Random(5)
    rooms = dimensions.clean_inventory(inventory(spark, ROOMS))
    rooms.collect()
    store = MartStore(spark, str(tmp_path / "store"), rooms)
    native, nordic = [], []
    for _ in range(2):
        a, b = _native(rng, 20), _nordic(rng, 20)
        native, nordic, before = native + a, nordic + b, _shuffle_files(spark)
        store.apply(_feeds(spark, a, b))
        left = _shuffle_files(spark) - before
        assert not [f for f in left if f.endswith(".data")], left
        store.vacuum()
        assert len([d for d in os.listdir(tmp_path / "store" / "latest") if d.startswith("_version") or "=" in d]) == len(store._registered) == 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    full = Marts(feeds=_feeds(spark, native, nordic), inventory_raw=inventory(spark, ROOMS))
    assert _kept(store.kept()) == _kept(full.kept) and _fact(store.fact(_capacity(rooms))) == _fact(full.fact)
    store.close()


def test_the_changes_alone_are_exchanged_and_once(spark, tmp_path):
    """In any session: the default exchanges both sides of a join on more
    columns than the table is bucketed by."""
    from staylens.plans import incremental
    rng = random.Random(6)
    store = MartStore(spark, str(tmp_path / "store"), dimensions.clean_inventory(inventory(spark, ROOMS)))
    store.apply(_feeds(spark, _native(rng, 30), _nordic(rng, 30)))
    changes = Marts(feeds=_feeds(spark, _native(rng, 30), _nordic(rng, 30)), inventory_raw=inventory(spark, ROOMS)).unified.cache()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with incremental._stored_in_place(spark):
            plan = plan_of(incremental._merged(store._latest(store._state()[1]), changes))
        assert plan.split("InMemoryRelation")[0].count("Exchange hashpartitioning") == 1, plan
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        changes.unpersist()
    store.close()
