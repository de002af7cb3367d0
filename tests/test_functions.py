"""Column functions: guarded casts, exact KPI arithmetic, fingerprints."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from staylens.functions import (
    adr, minutes_between, parse_date, parse_date_dmy, parse_money, parse_offset_timestamp,
    parse_timestamp, percent_2dp, stay_dates_fingerprint,
)
from staylens.functions.measures import hours_2dp


def one(spark, col, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("2026-05-01", dt.date(2026, 5, 1)),
    (" 2026-05-01 ", dt.date(2026, 5, 1)),
    ("2026-5-1", dt.date(2026, 5, 1)),
    ("2026", None),            # a bare year is not a date
    ("2026-05", None),
    ("2026/05/01", None),
    ("not-a-date", None),
    ("2026-02-30", None),
    (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, parse_date("v"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2026-04-01 09:00:00.000", dt.datetime(2026, 4, 1, 9, 0)),
    ("2026-04-01 09:00:00", dt.datetime(2026, 4, 1, 9, 0)),
    ("2026-04-01", dt.datetime(2026, 4, 1)),
    ("2026-04-01 09:00:00+02:00", None),
    ("yesterday", None),
])
def test_parse_timestamp(spark, text, expected):
    assert one(spark, parse_timestamp("v"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2026-04-02T09:00:00-05:00", dt.datetime(2026, 4, 2, 9, 0)),   # wall clock kept
    ("2026-04-02T09:00:00-0500", dt.datetime(2026, 4, 2, 9, 0)),
    ("2026-04-02T09:00:00+05", dt.datetime(2026, 4, 2, 9, 0)),
    ("2026-04-02T09:00:00Z", None),
    ("2026-04-02T09:00:00", None),
    ("2026-04-02T09:00:00.5-05:00", None),
])
def test_parse_offset_timestamp(spark, text, expected):
    assert one(spark, parse_offset_timestamp("v"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("01.05.2026", dt.date(2026, 5, 1)),
    ("1.5.2026", dt.date(2026, 5, 1)),
    (" 01.05.2026 ", dt.date(2026, 5, 1)),
    ("01.05.26", None),
    ("2026-05-01", None),
    ("31.02.2026", None),
])
def test_parse_date_dmy(spark, text, expected):
    assert one(spark, parse_date_dmy("v"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("117.50", Decimal("117.5")),
    (" 12 ", Decimal("12")),
    ("-3.25", Decimal("-3.25")),
    (".5", Decimal("0.5")),
    ("1e3", Decimal("1000")),
    ("1_000", None),
    ("n/a", None),
    ("", None),
    ("NaN", None),
    ("inf", None),
    ("1d", None),
])
def test_parse_money(spark, text, expected):
    got = one(spark, parse_money("v"), text)
    assert (got is None and expected is None) or got == expected


@pytest.mark.parametrize("n,d,expected", [
    (1, 4, 25.0), (1, 14, 7.14), (3, 2, 150.0), (2, 10, 20.0), (0, 10, 0.0),
    (1, 8, 12.5), (1, 32, 3.13), (201, 20000, 1.01),  # exact half-up at the cent
    (1, 0, None), (1, None, None),
])
def test_percent_2dp(spark, n, d, expected):
    got = spark.createDataFrame([(n, d)], "n int, d int").select(percent_2dp("n", "d").alias("r")).first()["r"]
    assert got == expected


@pytest.mark.parametrize("rev,occ,expected", [
    ("160", 1, 160), ("180", 2, 90), ("180", 3, 60), ("40", 0, 0),
    ("2.5", 1, 3), ("3.5", 1, 4), ("1.499999", 1, 1), ("301", 2, 151),
])
def test_adr_half_up(spark, rev, occ, expected):
    df = spark.createDataFrame([(rev, occ)], "rev string, occ int")
    got = df.select(adr(F.col("rev").cast("decimal(28,6)"), "occ").alias("r")).first()["r"]
    assert got == expected


def test_minutes_count_boundaries(spark):
    df = spark.createDataFrame([("2026-01-01 00:00:59", "2026-01-01 00:01:00")], "a string, b string")
    r = df.select(minutes_between(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("m")).first()
    assert r["m"] == 1


@pytest.mark.parametrize("m,h", [(180, 3.0), (600, 10.0), (1800, 30.0), (59, 0.98), (61, 1.02), (-61, -1.02)])
def test_hours_2dp(spark, m, h):
    assert one(spark, hours_2dp("v"), m, "v long") == h


def test_fingerprint_is_engine_neutral_and_without_order(spark):
    import hashlib
    items = [("LD", "2026-05-01", "2026-05-02", "120", "100", None, ""), ("LD", "2026-05-02", "2026-05-02", "1", "1", "", ""), ("X", *[None] * 6)]
    df = spark.createDataFrame(
        [(items,), (items[::-1],), (items[:1],), (items[:1] * 2,), ([],), (None,)],
        "s array<struct<room_type_id:string,start_date:string,end_date:string,room_gross:string,"
        "room_net:string,fnb_gross:string,fnb_net:string>>")
    got = [r["fp"] for r in df.select(stay_dates_fingerprint("s").alias("fp")).collect()]

    def plain(rows):
        texts = [hashlib.md5(",".join("\\N" if v is None else v for v in r).encode()).hexdigest() for r in rows]
        sums = [sum(int(t[a:a + 8], 16) for t in texts) for a in range(0, 32, 8)]
        return hashlib.md5(":".join(map(str, [*sums, len(rows)])).encode()).hexdigest()

    assert got == [plain(items), plain(items), plain(items[:1]), plain(items[:1] * 2), plain([]), None]
    assert len(set(got)) == 5
