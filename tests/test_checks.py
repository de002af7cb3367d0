"""Generic data-quality checks return exactly the violating rows."""

import datetime as dt

from staylens.operators import checks


def test_not_null_unique_accepted_relationships(spark):
    df = spark.createDataFrame([("H", "1", "confirmed"), ("H", "1", "bogus"), ("H", None, "cancelled"),
                                ("H", "2", None)], "hotel_id string, reservation_id string, status string")
    assert checks.not_null(df, "reservation_id").count() == 1
    assert [tuple(r) for r in checks.unique(df, ["hotel_id", "reservation_id"]).collect()] == [("H", "1", 2)]
    assert [r["status"] for r in checks.accepted_values(
        df, "status", ["confirmed", "cancelled", "checked_in", "checked_out"]).collect()] == ["bogus"]
    parent = spark.createDataFrame([("1",)], "rid string")
    orphans = checks.relationships(df, "reservation_id", parent, "rid", keep=["reservation_id"]).collect()
    assert [r["reservation_id"] for r in orphans] == ["2"]


def test_dedup_keeps_latest(spark):
    ts = dt.datetime
    unified = spark.createDataFrame(
        [("H", "1", ts(2026, 4, 1), True), ("H", "1", ts(2026, 4, 2), True), ("H", "1", ts(2026, 4, 3), False)],
        "hotel_id string, reservation_id string, updated_at timestamp_ntz, is_valid boolean")
    good = spark.createDataFrame([("H", "1", ts(2026, 4, 2))], "hotel_id string, reservation_id string, updated_at timestamp_ntz")
    bad = spark.createDataFrame([("H", "1", ts(2026, 4, 1))], "hotel_id string, reservation_id string, updated_at timestamp_ntz")
    assert checks.dedup_keeps_latest(good, unified, time="updated_at").count() == 0
    assert checks.dedup_keeps_latest(bad, unified, time="updated_at").count() == 1


def test_table_diff(spark):
    exp = spark.createDataFrame([("2026-05-01", 10, "a"), ("2026-05-02", 20, "b"), ("2026-05-03", 30, None)],
                                "d string, n int, s string")
    act = spark.createDataFrame([("2026-05-01", 10, "a"), ("2026-05-02", 21, "b"), ("2026-05-04", 40, "x"),
                                 ("2026-05-03", 30, None)], "d string, n int, s string")
    got = sorted((tuple(r) for r in checks.table_diff(exp, act, ["d"]).collect()), key=str)
    assert got == sorted([
        ("2026-05-02", 1, "both", 1, "n", "20", "21"),
        ("2026-05-04", 1, "actual", 1, "n", None, "40"), ("2026-05-04", 1, "actual", 1, "s", None, "x"),
        (None, 1, "rows", 1, None, "3", "4")], key=str)
    assert checks.table_diff(exp, exp, ["d"]).isEmpty()


def test_a_null_value_is_not_an_absent_row(spark):
    schema = "d string, n int"
    null, absent = spark.createDataFrame([("a", None), ("b", 1)], schema), spark.createDataFrame([("b", 1)], schema)
    got = [tuple(r) for r in checks.table_diff(null, absent, ["d"]).collect()]
    assert sorted(got, key=str) == sorted([("a", 1, "expected", 1, "n", None, None), (None, 1, "rows", 1, None, "2", "1")], key=str)
    filled = spark.createDataFrame([("a", 5), ("b", 1)], schema)
    assert [tuple(r) for r in checks.table_diff(null, filled, ["d"]).collect()] == [("a", 1, "both", 1, "n", None, "5")]
    # a NULL key is a key
    assert checks.table_diff(spark.createDataFrame([(None, 1)], schema), spark.createDataFrame([(None, 1)], schema), ["d"]).isEmpty()
    got = checks.table_diff(spark.createDataFrame([(None, 1)], schema), spark.createDataFrame([(None, 2)], schema), ["d"]).collect()
    assert [tuple(r) for r in got] == [(None, 1, "both", 1, "n", "1", "2")]


def test_repeated_keys_are_compared_as_multisets(spark):
    """Against a plain count: the rows named by the difference turn one side into the other."""
    import random
    from collections import Counter
    rng = random.Random(3)
    for _ in range(4):
        make = lambda: [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice(["x", "y"])) for _ in range(rng.randint(0, 25))]
        left, right = make(), make()
        schema = "k string, n int, s string"
        diff = [r.asDict() for r in checks.table_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"]).collect()]
        counts = [r for r in diff if r["side"] == "rows"]
        assert [(r["expected"], r["actual"]) for r in counts] == ([(str(len(left)), str(len(right)))] if len(left) != len(right) else [])
        gone, new = Counter(left) - Counter(right), Counter(right) - Counter(left)
        cells = [r for r in diff if r["side"] != "rows"]
        for side, have in (("expected", gone), ("actual", new)):
            other = "actual" if side == "expected" else "expected"
            whole = {}
            for r in cells:
                if r["side"] == side:
                    whole.setdefault((r["k"], r["occurrence"]), {"copies": r["copies"]})[r["column"]] = r[side]
                    assert r[other] is None
            paired = Counter()
            for r in cells:
                if r["side"] == "both":
                    paired[r["k"], r["occurrence"]] = r["copies"]
            per_key = Counter()
            for (k, n, s), c in have.items():
                per_key[k] += c
            found = Counter()
            for (k, _), w in whole.items():
                found[k] += w["copies"]
                assert have[(k, int(w["n"]) if w["n"] else None, w["s"])] >= w["copies"]
            for (k, _), c in paired.items():
                found[k] += c
            assert found == per_key


def test_a_row_that_is_repeated_very_often_is_counted_first(spark):
    from pyspark.sql import functions as F

    from test_plans import plan_of
    many = spark.range(30_000).select(F.lit("hot").alias("k"), F.lit(1).alias("n"))
    diff = checks.table_diff(many, many.limit(29_990), ["k"])
    got = [tuple(r) for r in diff.collect()]
    assert sorted(got, key=str) == sorted([("hot", 1, "expected", 10, "n", "1", None), (None, 1, "rows", 10, None, "30000", "29990")], key=str)
    assert "partial_sum" in plan_of(diff) and "ReusedExchange" in plan_of(diff)


def test_suite_passes_on_clean_data_and_flags_bad_status(spark, write_json):
    from staylens.plans.marts import Marts
    from staylens.plans.suite import failures, run_suite
    from staylens.sources import read_cloud, read_native

    from helpers import LODGE, ROOMS, inventory, lodge_events
    from test_sources import cloud_doc

    feeds = {"native": read_native(spark, write_json("n.json", {"data": lodge_events()})),
             "cloud": read_cloud(spark, write_json("c.json", cloud_doc(reservationStatus="CheckedOut")))}
    m = Marts(feeds=feeds, inventory_raw=inventory(spark, ROOMS))
    suite = run_suite(m, m.report(LODGE, "2031-03-10", "2031-03-12"))
    got = {(r["model"], r["test"], r["column_name"]): r["violations"] for r in failures(suite).collect()}
    assert {r["model"] for r in suite.collect()} >= {"kpi_report", "fct_daily_kpis"}
    assert got == {("stg_pms_cloud", "accepted_values", "status"): 1}


def test_a_single_unique_column_may_be_absent(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    assert checks.unique(df, ["k"]).isEmpty()
    assert not checks.unique(df.union(df), ["k"]).isEmpty()
