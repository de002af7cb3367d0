"""KPI fact and data-quality marts on small, fully known inputs."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from staylens.operators import checks, dimensions, kpis, quality
from staylens.schemas import MANIFEST_RAW, MARKET_RAW

D = dt.date


def nights_df(spark, rows):
    return spark.createDataFrame(
        [(h, r, D(2026, 5, d), s, c, room, Decimal(str(rev))) for h, r, d, s, c, room, rev in rows],
        "hotel_id string, reservation_id string, night date, status string, "
        "counts_for_occupancy boolean, room_type_id string, total_net_revenue decimal(19,6)")


def capacity_df(spark, rows):
    return spark.createDataFrame(rows, "hotel_id string, total_rooms long")


#: Three nights of a hut (8 beds) and one of an inn (1 bed, sold twice); what
#: was called off brings money but fills no bed.
NIGHTS = [
    ("hut", "walker", 11, "checked_in", True, "bunk", 23.75),
    ("hut", "walker", 12, "checked_in", True, "bunk", 23.75),
    ("hut", "club", 12, "confirmed", True, "loft", 41.5),
    ("hut", "late", 12, "cancelled", False, "loft", 9.25),
    ("hut", "late", 14, "cancelled", False, "loft", 9.25),
    ("inn", "anna", 12, "checked_out", True, "one", 77.0),
    ("inn", "omar", 12, "confirmed", True, "one", 80.01),
]


def test_fact_of_every_status(spark):
    fact = kpis.daily_kpis(nights_df(spark, NIGHTS), capacity_df(spark, [("hut", 8), ("inn", 1)]))
    got = sorted(tuple(r) for r in fact.select(*kpis.FACT_COLUMNS).collect())
    assert got == [
        ("hut", D(2026, 5, 11), 1, 8, 12.5, 23.75, 24),
        ("hut", D(2026, 5, 12), 2, 8, 25.0, 74.5, 37),
        ("hut", D(2026, 5, 14), 0, 8, 0.0, 9.25, 0),
        ("inn", D(2026, 5, 12), 2, 1, 200.0, 157.01, 79),
    ]
    assert checks.fact_invariants(fact).count() == 0


def test_fact_zero_and_unknown_capacity(spark):
    fact = kpis.daily_kpis(nights_df(spark, NIGHTS[:1] + NIGHTS[5:6]), capacity_df(spark, [("hut", 0)]))
    assert {r["hotel_id"]: r["occupancy_percentage"] for r in fact.collect()} == {"hut": None, "inn": None}
    rep = kpis.kpi_report(fact, "hut", "2026-05-11", "2026-05-11").first()
    assert rep["OCCUPANCY_PERCENTAGE"] == Decimal("0.00") and rep["ADR"] == 24


def test_report_fills_gaps_newest_first(spark):
    fact = kpis.daily_kpis(nights_df(spark, NIGHTS), capacity_df(spark, [("hut", 8), ("inn", 1)]))
    rep = kpis.kpi_report(fact, "hut", dt.date(2026, 5, 12), dt.date(2026, 5, 15))
    assert rep.columns == ["NIGHT_OF_STAY", "OCCUPANCY_PERCENTAGE", "TOTAL_NET_REVENUE", "ADR"]
    assert [tuple(r) for r in rep.collect()] == [
        ("2026-05-15", Decimal("0.00"), Decimal("0.00"), 0),
        ("2026-05-14", Decimal("0.00"), Decimal("9.25"), 0),
        ("2026-05-13", Decimal("0.00"), Decimal("0.00"), 0),
        ("2026-05-12", Decimal("25.00"), Decimal("74.50"), 37),
    ]


def kept_df(spark, rows):
    return spark.createDataFrame(
        [(s, h, r, dt.datetime.fromisoformat(u)) for s, h, r, u in rows],
        "source_system string, hotel_id string, reservation_id string, updated_at timestamp_ntz")


def test_watermarks_and_freshness(spark):
    kept = kept_df(spark, [
        ("native", "1035", "a", "2026-05-31 10:00:00"), ("native", "1036", "b", "2026-06-01 01:00:00"),
        ("nordic", "2050", "c", "2026-06-03 00:00:00"), ("cloud", "3120", "d", "2026-05-30 06:00:00"),
    ])
    wm = {(r["source_system"], r["hotel_id"]): (r["max_event_at"], r["reservations"])
          for r in quality.event_watermarks(kept).collect()}
    assert wm[("native", "__all__")] == (dt.datetime(2026, 6, 1, 1), 2)
    assert wm[("native", "1035")] == (dt.datetime(2026, 5, 31, 10), 1)
    assert len(wm) == 7
    manifest = dimensions.clean_manifest(spark.createDataFrame([
        ("native", "2026-06-01 03:00:00", "24"), ("nordic", "2026-05-31 20:00:00", "24"),
        ("cloud", "2026-05-31 00:00:00", "24"), ("other", None, "24")], MANIFEST_RAW))
    fresh = quality.data_freshness(quality.event_watermarks(kept), manifest, dt.datetime(2026, 6, 1, 6))
    got = {(r["source_system"], r["hotel_id"]): (r["load_lag_hours"], r["event_lag_hours"], r["is_stale"])
           for r in fresh.collect()}
    assert got[("native", "__all__")] == (3.0, 5.0, False)
    assert got[("nordic", "__all__")] == (10.0, 0.0, False)     # event after as-of floors at 0
    assert got[("cloud", "__all__")] == (30.0, 48.0, True)
    assert checks.freshness_sla(fresh).count() == 0


def test_availability(spark):
    fact = spark.createDataFrame([
        ("H1", D(2026, 5, 1), 2), ("H1", D(2026, 5, 3), 12), ("H0", D(2026, 5, 1), 1)],
        "hotel_id string, night date, occupied_rooms long")
    cap = capacity_df(spark, [("H1", 10), ("H0", 0)])
    av = {(r["hotel_id"], r["night"].day): r for r in quality.data_availability(fact, cap).collect()}
    assert sorted(av) == [("H0", 1), ("H1", 1), ("H1", 2), ("H1", 3)]
    assert av[("H1", 2)]["is_missing_day"] and av[("H1", 2)]["missing_room_nights"] == 10
    assert av[("H1", 3)]["availability_pct"] == 100.0 and av[("H1", 3)]["missing_room_nights"] == 0
    assert av[("H1", 1)]["availability_pct"] == 20.0
    assert av[("H0", 1)]["availability_pct"] == 100.0          # zero capacity reads as covered...
    bad = checks.availability_bounds(quality.data_availability(fact, cap)).collect()
    assert [r["hotel_id"] for r in bad] == ["H0"]              # ...and the bounds check flags it


def test_market_blend(spark):
    fact = spark.createDataFrame([
        ("H1", D(2026, 5, 14), 50.0, 300.0, 150), ("H1", D(2026, 5, 15), 0.0, 0.0, 0),
        ("H2", D(2026, 5, 14), 10.0, 90.0, 90), ("H1", D(2026, 5, 16), 10.0, 90.0, 90)],
        "hotel_id string, night date, occupancy_percentage double, total_net_revenue double, adr long")
    market = dimensions.clean_market(spark.createDataFrame([
        ("H1", "2026-05-14", "118", "city_conference"), ("H1", "2026-05-15", "100", " "),
        ("H1", "2026-05-16", "0", ""), ("H1", "bad", "100", "")], MARKET_RAW))
    got = {(r["hotel_id"], r["night"].day): r for r in quality.market_blend(fact, market).collect()}
    assert got[("H1", 14)]["rate_vs_market_index"] == 127.12 and got[("H1", 14)]["has_local_event"]
    assert got[("H1", 15)]["rate_vs_market_index"] is None and got[("H1", 15)]["local_event"] is None
    assert got[("H1", 16)]["rate_vs_market_index"] is None       # index 0: no position
    assert got[("H2", 14)]["comp_rate_index"] is None and got[("H2", 14)]["has_local_event"] is False
    assert checks.unique(quality.market_blend(fact, market), ["hotel_id", "night"]).count() == 0


def test_reconciliation_passes_and_fails(spark):
    control = spark.createDataFrame(
        [("native", 3, 150.25, 4, Decimal("150.2504")), ("cloud", 2, 49.75, 2, Decimal("49.7496"))],
        "source_system string, occupied_room_nights long, total_net_revenue double, room_nights long, "
        "net_revenue_exact decimal(38,6)")
    fact = spark.createDataFrame([("H1", D(2026, 5, 1), 5, 200.0, Decimal("200"))],
                                 "hotel_id string, night date, occupied_rooms long, total_net_revenue double, "
                                 "net_revenue_exact decimal(38,6)")
    rep = quality.reconciliation(control, fact)
    total = rep.where(F.col("source_system") == "__total__").first()
    assert total["reconciled"] is True and total["total_net_revenue_diff"] == 0.0
    assert checks.reconciliation_gate(rep).count() == 0 and checks.source_totals_match_fact(rep).count() == 0
    off = quality.reconciliation(control, fact.withColumn("net_revenue_exact", F.lit("200.02").cast("decimal(38,6)")))
    assert checks.reconciliation_gate(off).count() == 1
    assert checks.source_totals_match_fact(off).count() == 1
    empty = quality.reconciliation(control.limit(0), fact.limit(0))
    assert [tuple(r) for r in checks.reconciliation_gate(empty).select("reconciled").collect()] == [(False,)]


def test_many_sub_cent_nights_reconcile(spark):
    """Rounded cells drift apart from a total rounded once; exact sums don't."""
    nights = spark.createDataFrame([("H1", f"r{i}", D(2026, 5, 1 + i % 28), "confirmed", True, "LD", Decimal("10.005")) for i in range(28)],
                                   "hotel_id string, reservation_id string, night date, status string, "
                                   "counts_for_occupancy boolean, room_type_id string, total_net_revenue decimal(29,6)")
    fact = kpis.daily_kpis(nights, capacity_df(spark, [("H1", 10)]))
    control = nights.groupBy(F.lit("native").alias("source_system")).agg(
        F.count("*").alias("occupied_room_nights"), F.round(F.sum("total_net_revenue"), 2).cast("double").alias("total_net_revenue"),
        F.count("*").alias("room_nights"), F.sum("total_net_revenue").cast("decimal(38,6)").alias("net_revenue_exact"))
    total = quality.reconciliation(control, fact).where("source_system = '__total__'").first()
    assert total["reconciled"] and total["total_net_revenue_diff"] == 0.0


def test_percent_of_a_negative_is_rounded_half_up(spark):
    from staylens.functions.measures import adr, percent_2dp
    row = spark.range(1).select(percent_2dp(F.lit(100), F.lit(-3)).alias("a"), percent_2dp(F.lit(-1), F.lit(800)).alias("b"),
                                percent_2dp(F.lit(5), F.lit(0)).alias("c"),
                                adr(F.lit("-2.5").cast("decimal(38,6)"), F.lit(1)).alias("d"),
                                adr(F.lit("7.499999").cast("decimal(38,6)"), F.lit(1)).alias("e")).first()
    assert tuple(row) == (-3333.33, -0.13, None, -3, 7)
