"""Bookings and stays that are too large for one task: flat line items, dealt
out where they are many, and long stays generated by months."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from staylens.operators import adapters, quality, reservations
from staylens.plans.marts import Marts
from staylens.schemas import NORDIC_ROW

from helpers import ROOMS, inventory
from test_plans import plan_of

HOTEL, ROOM = next((r[0], r[1]) for r in ROOMS)


def _nights(spark, rows):
    """Nordic night rows of (booking, arrival, departure, night, room, gross)."""
    text = lambda d: f"{d:%d.%m.%Y}"
    return spark.createDataFrame(
        [(HOTEL, b, "OK", text(a), text(z), text(n), room, "EUR", str(gross), "1.5", "" if gross % 3 else "11.0") for b, a, z, n, room, gross in rows], NORDIC_ROW)


def _random_rows(seed, n):
    rng = random.Random(seed)
    start = dt.date(2031, 1, 1)
    rows = []
    for i in range(n):
        b = "hot" if i % 3 == 0 else f"b{rng.randint(0, n // 6)}"
        stay = 900 if b == "hot" else 5
        rows.append((b, start, start + dt.timedelta(stay), start + dt.timedelta(rng.randint(-1, stay)), rng.choice([ROOM, ROOM, "none"]), rng.randint(1, 40)))
    return rows


def _brute(rows):
    """{(booking, night): best revenue} over all valid, stocked nights."""
    best = {}
    for b, a, z, n, room, gross in rows:
        if room != ROOM or not a <= n < z:
            continue
        board = Decimal(0) if gross % 3 else Decimal("10.00")
        revenue = Decimal(gross) - Decimal("1.5") + board
        best[b, n] = max(best.get((b, n), revenue), revenue)
    return best


@pytest.mark.parametrize("materialize", [False, True])
def test_flat_items_give_the_same_nights(spark, materialize):
    rows = _random_rows(1, 2400)
    m = Marts(feeds={"nordic": _nights(spark, rows).repartition(5)}, inventory_raw=inventory(spark, ROOMS), materialize=materialize)
    want = _brute(rows)
    got = {(r["reservation_id"], r["night"]): r["total_net_revenue"] for r in m.nights.collect()}
    assert got == want
    control = quality.control_nights(m.kept, m.inventory, m.flat_items)
    assert {(r["reservation_id"], r["night"]): r["rev"] for r in control.collect()} == want
    assert m.reconciliation.filter("source_system = '__total__'").first()["reconciled"]
    m.drop()


def test_no_list_is_built(spark):
    plan = plan_of(adapters.adapt_nordic(_nights(spark, _random_rows(1, 10))))
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan and "partial_sum" in plan


def test_a_hot_booking_is_dealt_out(spark):
    """A third of all rows are of one booking; a task that joins items with
    their headers has three times the usual rows at most."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        start = F.lit("01.01.2031")
        n = 60_000
        raw = spark.range(n, numPartitions=6).select(
            F.lit(HOTEL).alias("property_code"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), (F.col("id") % 5003).cast("string"))).alias("booking_ref"),
            F.lit("OK").alias("stay_status"), start.alias("checkin"), F.lit("01.01.2034").alias("checkout"),
            F.date_format(F.date_add(F.lit(dt.date(2031, 1, 1)), (F.col("id") % 900).cast("int")), "dd.MM.yyyy").alias("stay_night"),
            F.lit(ROOM).alias("room_code"), F.lit("EUR").alias("currency"), F.lit("10").alias("room_gross_eur"), F.lit("1").alias("room_vat_eur"), F.lit("").alias("board_gross_eur"))
        m = Marts(feeds={"nordic": raw}, inventory_raw=inventory(spark, ROOMS), materialize=True)
        assert m.kept.filter("reservation_id = 'hot'").first()["n_items"] == n // 3
        joined = reservations.with_headers(m.flat_items, m.kept, ["hotel_id", "reservation_id", "status"])
        per_task = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sum(per_task) == n and per_task[-1] <= 3 * per_task[len(per_task) // 2]
        m.drop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_items_that_are_not_given_are_an_error(spark):
    feeds = {"nordic": _nights(spark, _random_rows(1, 30))}
    kept = reservations.dedup_latest(adapters.unified_feed(feeds))
    with pytest.raises(Exception, match="which were not given"):
        reservations.line_items(kept).collect()


def _long_kept(spark, last):
    schema = ("source_system string, hotel_id string, reservation_id string, status string, arrival_date date, departure_date date, created_at timestamp_ntz,"
              " updated_at timestamp_ntz, updated_instant timestamp_ntz, stay_dates array<struct<room_type_id:string,start_date:string,end_date:string,"
              "room_gross:string,room_net:string,fnb_gross:string,fnb_net:string>>, n_items long, items_md5 string, counts_for_occupancy boolean")
    now = dt.datetime(2031, 1, 1)

    def row(key, arrival, departure, *items):
        return ("native", HOTEL, key, "confirmed", arrival, departure, now, now, now,
                [(ROOM, str(a), str(b), r, r, None, None) for a, b, r in items], len(items), "x", True)

    d = dt.date
    return spark.createDataFrame([
        row("long", d(1, 1, 1), last, (d(1, 1, 1).isoformat(), last.isoformat(), "1"), ("2031-01-05", "2031-01-09", "3")),
        row("short", d(2031, 1, 30), d(2031, 3, 2), ("2031-01-30", "2031-03-02", "2"), ("2031-02-01", "2031-02-01", "5")),
        row("none", d(2031, 1, 30), d(2031, 2, 2), ("2031-02-02", "2031-02-02", "2"))], schema)


def test_long_stays_give_every_night_once(spark):
    from staylens.operators.dimensions import clean_inventory
    rooms = clean_inventory(inventory(spark, ROOMS))
    kept = _long_kept(spark, dt.date(40, 3, 1))
    got = {(r["reservation_id"], r["night"]): int(r["total_net_revenue"]) for r in reservations.reservation_nights(kept, rooms).collect()}
    day = dt.timedelta(1)
    want = {("long", dt.date(1, 1, 1) + i * day): 1 for i in range((dt.date(40, 3, 1) - dt.date(1, 1, 1)).days)}
    want |= {("short", dt.date(2031, 1, 30) + i * day): 2 for i in range(31)} | {("short", dt.date(2031, 2, 1)): 5}
    assert got == want
    control = quality.control_nights(kept, rooms)
    assert {(r["reservation_id"], r["night"]): int(r["rev"]) for r in control.collect()} == want


def test_a_stay_of_millions_of_nights_is_generated_by_all_tasks(spark):
    from staylens.operators.dimensions import clean_inventory
    rooms = clean_inventory(inventory(spark, ROOMS))
    kept = _long_kept(spark, dt.date(9999, 12, 31)).filter("reservation_id = 'long'")
    items = reservations.in_inventory(reservations.validated_line_items(kept), rooms)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nights = reservations.expand_nights(items, spread=True)
        per_task = sorted(r["count"] for r in nights.groupBy(F.spark_partition_id()).count().collect())
        total = (dt.date(9999, 12, 31) - dt.date(1, 1, 1)).days
        assert total > 3_600_000 and sum(per_task) == total + 5
        assert len(per_task) >= 4 and per_task[-1] <= 2 * total / len(per_task)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_availability_spine_is_generated_by_all_tasks(spark):
    fact = spark.createDataFrame([(HOTEL, dt.date(1, 1, 1), 1), (HOTEL, dt.date(2200, 1, 1), 1)], "hotel_id string, night date, occupied_rooms long")
    got = quality.data_availability(fact, spark.createDataFrame([(HOTEL, 4)], "hotel_id string, total_rooms long"))
    row = got.agg(F.count("*").alias("n"), F.count_distinct("night").alias("d"), F.sum("occupied_rooms").alias("o"), F.min("night").alias("a"), F.max("night").alias("z")).first()
    days = (dt.date(2200, 1, 1) - dt.date(1, 1, 1)).days + 1
    assert tuple(row) == (days, days, 2, dt.date(1, 1, 1), dt.date(2200, 1, 1))
    assert "_month" in plan_of(got)
