"""The KPI rules on a small native feed: which snapshot counts, which lines
count, and what the report then shows."""

from decimal import Decimal

import pytest

from staylens.plans.marts import Marts
from staylens.sources import read_native

from helpers import LODGE, LODGE_REPORT, ROOMS, booking, inventory, lodge_events


@pytest.fixture
def build(spark, write_json):
    def _build(events, rooms=ROOMS):
        feed = read_native(spark, write_json("native.json", {"data": events}))
        return Marts(feeds={"native": feed}, inventory_raw=inventory(spark, rooms))
    return _build


def nights_of(m):
    return sorted((r["reservation_id"], r["night"].day, r["room_type_id"], float(r["total_net_revenue"])) for r in m.nights.collect())


def test_lodge_report(build):
    rows = build(lodge_events()).report(LODGE, "2031-03-10", "2031-03-13").collect()
    assert [(n, str(o), str(v), a) for n, o, v, a in rows] == LODGE_REPORT


def test_report_with_from_after_to_is_empty(build):
    assert build(lodge_events()).report(LODGE, "2031-03-13", "2031-03-10").collect() == []


def test_last_sent_valid_snapshot_counts(build):
    kept = {r["reservation_id"]: (r["status"], r["departure_date"].day) for r in build(lodge_events()).kept.collect()}
    assert kept == {"ext": ("checked_in", 13), "off": ("cancelled", 12), "food": ("checked_out", 13), "unsold": ("confirmed", 11)}


def test_a_broken_resend_hides_nothing(build):
    resend = booking("off", [("TW", 11, 11, "1")], (11, 12), "???", sent="2031-03-09 00:00:00")
    kept = {r["reservation_id"]: r["status"] for r in build([*lodge_events(), resend]).kept.collect()}
    assert kept["off"] == "cancelled"


def test_ties_in_time_do_not_depend_on_order(build):
    pair = [booking("t", [("QN", 10, 10, amount)], (10, 11)) for amount in ("41", "44")]
    one, other = build(pair).kept.collect(), build(pair[::-1]).kept.collect()
    assert one == other and len(one) == 1


@pytest.mark.parametrize("spec", [
    ("QN", 15, 15, "twelve"),            # no number
    ("QN", 15, 15, "12", "soup"),        # meals are no number
    ("QN", 13, 14, "12"),                # begins before the stay
    ("QN", 16, 19, "12"),                # ends after it
    ("QN", 16, 15, "12"),                # ends before it begins
    ("QN", "15/03/2031", 15, "12"),      # date in another form
    (None, 15, 15, "12"),                # no room type
])
def test_bad_lines_go_and_good_ones_stay(build, spec):
    good = ("TW", 14, 14, "19.5")
    m = build([booking("b", [spec, good], (14, 18))])
    assert nights_of(m) == [("b", 14, "TW", 19.5)]


def test_the_day_of_leaving_is_no_night(build):
    m = build([booking("b", [("QN", 16, 18, "20")], (16, 18))])
    assert [n for _, n, _, _ in nights_of(m)] == [16, 17]


def test_one_room_a_night_dearest_then_smallest_code(build):
    m = build([booking("b", [("TW", 20, 20, "55"), ("QN", 20, 20, "55"), ("TW", 20, 20, "54")], (20, 21))])
    assert nights_of(m) == [("b", 20, "QN", 55.0)]
    assert m.fact.first()["occupied_rooms"] == 1


def test_no_lines_no_reservation(build):
    m = build([booking("b", [])])
    assert [r["is_valid"] for r in m.unified.collect()] == [False] and m.kept.isEmpty()


def test_amounts_keep_every_digit(build):
    """Fractions of a cent add up before they are rounded, and amounts of 13
    and more digits are amounts."""
    lines = [("QN", 10 + i, 10 + i, "10.00512345") for i in range(8)]
    m = build([booking("b", lines, (10, 18)), booking("rich", [("TW", 10, 10, "4111222333444.55")], (10, 11))])
    got = {r["night"].day: r["total_net_revenue"] for r in m.fact.collect()}
    assert got[11] == 10.01 and got[10] == 4111222333454.56
    total = m.reconciliation.filter("source_system = '__total__'").first()
    assert total["reconciled"] and total["total_net_revenue_diff"] == 0
    assert total["total_net_revenue"] == pytest.approx(4111222333524.59, abs=0.001)


def test_a_fault_of_the_fact_path_does_not_reconcile(build, monkeypatch):
    """The control path has its own casts and line rules."""
    from pyspark.sql import functions as F

    from staylens.operators import reservations
    monkeypatch.setattr(reservations, "valid_line_item", lambda: F.col("room_net") < 80)
    total = build(lodge_events()).reconciliation.filter("source_system = '__total__'").first()
    assert total["reconciled"] is False and total["occupied_room_nights_diff"] > 0


def test_decimal_report_types(build):
    row = build(lodge_events()).report(LODGE, "2031-03-11", "2031-03-11").first()
    assert row["TOTAL_NET_REVENUE"] == Decimal("145.40") and row["OCCUPANCY_PERCENTAGE"] == Decimal("12.50")
