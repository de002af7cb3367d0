"""Physical-plan properties the engine relies on at scale, checked on the
plans Spark actually produces."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from staylens.operators import adapters, kpis, reservations
from staylens.plans.marts import Marts
from staylens.sinks import read_table, write_table
from staylens.sources import read_native

from helpers import ROOMS, booking, inventory, lodge_events


def plan_of(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _marts(spark, write_json, events, materialize):
    path = write_json("native.json", {"data": events})
    return Marts(feeds={"native": read_native(spark, path)},
                 inventory_raw=inventory(spark, ROOMS), materialize=materialize)


def test_dedup_limits_before_the_shuffle(spark, write_json):
    plan = plan_of(_marts(spark, write_json, lodge_events(), False).kept)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the partial top-1 sits below the exchange on (hotel_id, reservation_id)
    lines = plan.splitlines()
    ex = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(hotel_id" in l)
    assert any("WindowGroupLimit" in l and "Partial" in l for l in lines[ex:])


def test_nights_reuse_dedup_partitioning(spark, write_json):
    for materialize in (False, True):
        m = _marts(spark, write_json, lodge_events(), materialize)
        plan = plan_of(m.nights)
        exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
        # the reservation data is shuffled at most once, by the dedup itself
        # (none at all from the bucketed snapshots); never again on
        # (hotel, reservation, night). The other exchange belongs to the
        # small, broadcast inventory.
        assert all("night" not in l for l in exchanges), exchanges
        on_reservation = [l for l in exchanges if "reservation_id" in l]
        assert len(on_reservation) == (0 if materialize else 1), exchanges


def test_daily_aggregate_is_partial_then_final(spark, write_json):
    plan = plan_of(_marts(spark, write_json, lodge_events(), False).fact)
    assert "partial_count" in plan and "partial_sum" in plan


def test_report_filters_reach_the_parquet_scan(spark, tmp_path):
    fact = spark.createDataFrame(
        [("H", dt.date(2026, 5, d), 1, 4, 25.0, 100.0, 100) for d in range(1, 4)],
        "hotel_id string, night date, occupied_rooms long, total_rooms long, "
        "occupancy_percentage double, total_net_revenue double, adr long")
    path = str(tmp_path / "fact")
    write_table(fact, path, by_night=True)
    stored = read_table(spark, path)
    report = kpis.kpi_report(stored, "H", "2026-05-02", "2026-05-03")
    plan = plan_of(report, "formatted")
    pushed = next(l for l in plan.splitlines() if l.startswith("PushedFilters"))
    assert "EqualTo(hotel_id,H)" in pushed and "GreaterThanOrEqual(night,2026-05-02)" in pushed
    assert "LessThanOrEqual(night,2026-05-03)" in pushed
    assert "(night_month" in next(l for l in plan.splitlines() if l.startswith("PartitionFilters"))
    read_schema = next(l for l in plan.splitlines() if l.startswith("ReadSchema"))
    assert "occupied_rooms" not in read_schema and "total_rooms" not in read_schema
    assert [r["NIGHT_OF_STAY"] for r in report.collect()] == ["2026-05-03", "2026-05-02"]


def test_hot_reservation_with_a_third_of_all_events(spark, write_json):
    """One reservation carries a third of all snapshots; the result is whole
    and equals the latest valid snapshot."""
    hot = [booking("hot", [("QN", 10, 11, 100 + i)],
                   sent=(dt.datetime(2031, 2, 1) + dt.timedelta(minutes=i)).strftime("%Y-%m-%d %H:%M:%S")) for i in range(300)]
    cold = [booking(f"c{i}", [("QN", 10, 10, 10)], (10, 11)) for i in range(600)]
    m = _marts(spark, write_json, hot + cold, True)
    kept = m.kept
    assert kept.count() == 601
    assert kept.where(F.col("reservation_id") == "hot").first()["updated_at"] == dt.datetime(2031, 2, 1, 4, 59)
    fact = {r["night"].day: (r["occupied_rooms"], r["total_net_revenue"]) for r in m.fact.collect()}
    assert fact == {10: (601, 399.0 + 6000.0), 11: (1, 399.0)}


def test_one_scan_of_lineitem_serves_all_feeds(spark, tmp_path):
    """The join is written once; a feed reads its hotels' folders only."""
    from staylens.sources import testdata
    feeds = testdata.feeds(spark, "/root/testdata/sf0.001", str(tmp_path / "events"))
    for name, hotels in (("native", "(hn"), ("nordic", "(hn"), ("cloud", "(hn")):
        plan = plan_of(feeds[name], "formatted")
        assert "Join" not in plan and "Exchange" not in plan and "l_orderkey" not in plan
        assert hotels in next(l for l in plan.splitlines() if l.startswith("PartitionFilters"))
    whole = testdata.feeds(spark, "/root/testdata/sf0.001")
    for name in feeds:
        assert feeds[name].exceptAll(whole[name]).isEmpty() and whole[name].exceptAll(feeds[name]).isEmpty()


def test_report_opens_only_its_months(spark, tmp_path):
    from staylens.sources.landing import write_by_month
    rows = [(f"H{h}", dt.date(2031, m, d), 1, 4, 25.0, 100.0, 100) for h in range(3) for m in (1, 2, 3) for d in range(1, 20)]
    fact = spark.createDataFrame(rows, "hotel_id string, night date, occupied_rooms long, total_rooms long, "
                                       "occupancy_percentage double, total_net_revenue double, adr long")
    stored = write_by_month(fact, str(tmp_path / "fact"))
    report = kpis.kpi_report(stored, "H1", "2031-02-05", "2031-02-09")
    assert [r["ADR"] for r in report.collect()] == [100] * 5
    plan = plan_of(report, "formatted")
    assert "(night_month" in next(l for l in plan.splitlines() if l.startswith("PartitionFilters"))


def test_bucketed_write_falls_back_to_plain_parquet(spark, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException
    from pyspark.sql import DataFrameWriter

    from staylens.sources.landing import write_bucketed

    def refuse(self, *a, **k):
        raise AnalysisException("no catalog here")

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", refuse)
    df = spark.createDataFrame([("H", "1"), ("H", "2")], "hotel_id string, reservation_id string")
    import pytest
    with pytest.warns(UserWarning):
        out = write_bucketed(df, str(tmp_path), "kept", ["hotel_id", "reservation_id"])
    assert sorted(r["reservation_id"] for r in out.collect()) == ["1", "2"]

    def break_off(self, *a, **k):
        raise RuntimeError("disk full")

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", break_off)
    with pytest.raises(RuntimeError, match="disk full"):
        write_bucketed(df, str(tmp_path), "kept", ["hotel_id", "reservation_id"])


def test_only_the_latest_snapshots_are_fingerprinted(spark):
    """The marts' dedup makes fingerprints after it has ranked the instants, and
    keeps what a dedup of the fingerprinted feed keeps."""
    from staylens.plans.catalog import testdata
    from staylens.plans.marts import Marts
    feeds = testdata.feeds(spark, "/root/testdata/sf0.001")
    feeds = {s: df.unionAll(df.limit(40)) for s, df in feeds.items()}
    m = Marts(feeds=feeds, inventory_raw=testdata.inventory_raw(spark, "/root/testdata/sf0.001"))
    kept = m.kept
    plan = plan_of(kept, "extended")
    plan = plan[plan.index("Physical Plan"):]
    assert plan.index("row_number(") < plan.index("aggregate(") < plan.index("rank(updated_instant")  # a plan is read from its end
    want = reservations.dedup_latest(adapters.unified_feed(feeds))
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()


def test_a_text_is_parsed_once_however_often_its_value_is_named(spark, write_json):
    """The validity rules name dates and amounts several times; filtering by
    them must not parse the texts anew."""
    m = _marts(spark, write_json, lodge_events(), False)
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized(m.unified.where("is_valid")).count("RLIKE") == 5  # four times and the instant
    assert optimized(reservations.validated_line_items(m.unified.withColumn("counts_for_occupancy", F.lit(True)))).count("RLIKE") == 5 + 6


def test_which_list_is_missing_is_read_off_one_field(spark, write_json):
    plan = plan_of(_marts(spark, write_json, lodge_events(), True).kept.where(reservations.is_flat()).select("hotel_id"), "formatted")
    assert "stay_dates:array<struct<room_type_id:string>>" in next(l for l in plan.splitlines() if l.startswith("ReadSchema"))


def test_landed_feeds_are_sorted_in_small_splits(spark):
    from staylens.sources.landing import SORTED_BYTES, small_splits
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, want in (("128MB", SORTED_BYTES), ("1m", 1 << 20), (str(SORTED_BYTES + 1), SORTED_BYTES)):
            spark.conf.set(key, given)
            try:
                with small_splits(spark):
                    assert int(spark.conf.get(key).removesuffix("b")) == want
                    raise RuntimeError("the write failed")
            except RuntimeError:
                assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, before)


def test_the_control_path_is_compiled(spark):
    """The JVM interprets a method of more than 8,000 bytes and never compiles it."""
    import re

    from staylens.operators import quality
    from staylens.sources import testdata
    feeds = testdata.feeds(spark, "/root/testdata/sf0.001")
    m = Marts(feeds=feeds, inventory_raw=testdata.inventory_raw(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cells = quality.control_cells(m.kept, m.inventory, m.flat_items)
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        code = debug.codegenString(cells._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000
