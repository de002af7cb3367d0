"""Landing and materialized tables."""

import glob

from pyspark.sql import functions as F

from staylens.operators import reservations
from staylens.plans.marts import Marts
from staylens.sources import read_native
from staylens.sources.landing import land, write_bucketed

from helpers import ROOMS, booking, inventory, lodge_events
from test_plans import plan_of


def test_land_keeps_the_text_schema(spark, tmp_path, write_json):
    feed = read_native(spark, write_json("n.json", {"data": lodge_events()}))
    landed = land({"native": feed}, str(tmp_path / "zone"))["native"]
    assert landed.schema == feed.schema
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, feed.collect()))


def test_bucketed_snapshots_one_file_per_bucket(spark, tmp_path, write_json):
    events = [booking(i % 40, [("QN", 10, 11, i + 1)], sent=f"2031-02-01 09:{i % 60:02d}:00") for i in range(200)]
    m = Marts(feeds={"native": read_native(spark, write_json("n.json", {"data": events}))},
              inventory_raw=inventory(spark, ROOMS))
    kept = write_bucketed(reservations.dedup_latest(m.unified), str(tmp_path), "kept",
                          ["hotel_id", "reservation_id"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert kept.count() == 40
    assert len(glob.glob(f"{tmp_path}/staylens_kept_*/*.parquet")) <= n
    # reading it back, a rank on a superset of the bucket keys needs no exchange
    nights = reservations.one_room_per_night(reservations.expand_nights(
        reservations.in_inventory(reservations.validated_line_items(kept), m.inventory)))
    assert not [l for l in plan_of(nights).splitlines() if "Exchange hashpartitioning" in l and "night" in l and "reservation" in l]
    assert nights.agg(F.countDistinct("reservation_id")).first()[0] == 40


def _jobs(spark, run):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    out = run()
    return out, len(set(tracker.getJobIdsForGroup(None)) - before)


def test_rows_are_counted_as_they_land(spark, tmp_path):
    """One job a feed: the counts need none of their own."""
    from staylens.sources.feeds import empty_feed
    from staylens.sources.landing import land_counted
    feed = spark.range(1000, numPartitions=3).selectExpr("cast(id as string) AS hotel_id")
    feeds = {"native": feed, "nordic": feed.filter("hotel_id < '3'"), "cloud": empty_feed(spark, "cloud")}
    (landed, counts), jobs = _jobs(spark, lambda: land_counted(feeds, str(tmp_path / "zone")))
    assert jobs <= 3
    assert counts == {s: df.count() for s, df in landed.items()} and counts["native"] == 1000 and counts["cloud"] == 0
