"""The shipped seed tables through the seed readers and cleaning steps."""

import datetime as dt
import os

from pyspark.sql import functions as F

from staylens.operators import dimensions, quality
from staylens.sources import read_inventory, read_manifest, read_market

SEEDS = os.path.join(os.path.dirname(__file__), "fixtures", "seeds")


def test_inventory_capacity(spark):
    inv = dimensions.clean_inventory(read_inventory(spark, f"{SEEDS}/hotel_room_inventory.csv"))
    assert inv.count() == 17
    cap = {r["hotel_id"]: r["total_rooms"] for r in dimensions.hotel_capacity(inv).collect()}
    assert cap == {"1035": 14, "1036": 9, "2050": 15, "3120": 25, "3121": 25}


def test_manifest_freshness(spark):
    manifest = dimensions.clean_manifest(read_manifest(spark, f"{SEEDS}/source_load_manifest.csv"))
    assert manifest.count() == 3
    kept = spark.createDataFrame(
        [("native", "1035", "a", dt.datetime(2026, 5, 31, 12)), ("nordic", "2050", "b", dt.datetime(2026, 5, 20)),
         ("cloud", "3120", "c", dt.datetime(2026, 5, 30, 18))],
        "source_system string, hotel_id string, reservation_id string, updated_at timestamp_ntz")
    fresh = quality.data_freshness(quality.event_watermarks(kept), manifest, dt.datetime(2026, 6, 1, 6))
    lags = {r["source_system"]: (r["load_lag_hours"], r["is_stale"])
            for r in fresh.where(F.col("hotel_id") == "__all__").collect()}
    assert lags == {"native": (3.0, False), "nordic": (10.0, False), "cloud": (30.0, True)}


def test_market_index(spark):
    market = dimensions.clean_market(read_market(spark, f"{SEEDS}/market_rate_index.csv"))
    assert market.count() == 124
    per_hotel = {r["hotel_id"]: r["count"] for r in market.groupBy("hotel_id").count().collect()}
    assert per_hotel == {"1035": 31, "2050": 31, "3120": 31, "3121": 31}    # none for 1036
    r = market.where((F.col("hotel_id") == "1035") & (F.col("night") == dt.date(2026, 5, 14))).first()
    assert (r["comp_rate_index"], r["local_event"], r["has_local_event"]) == (118, "city_conference", True)
    assert market.where(~F.col("has_local_event")).where(F.col("local_event").isNotNull()).count() == 0
