"""Reading the three raw feeds (nothing may be lost), and the Nordic and cloud
normalisers."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from staylens.operators import adapters
from staylens.schemas import NORDIC_ROW
from staylens.sources import load_all, load_raw, read_cloud, read_native, read_nordic

from helpers import booking

HEADER = ["property_code", "booking_ref", "stay_status", "checkin", "checkout", "stay_night", "room_code",
          "currency", "room_gross_eur", "room_vat_eur", "board_gross_eur"]

DOES_NOT_PARSE = "MALFORMED|does not parse|no list|cut off"



def nordic_csv(*rows, header=HEADER) -> str:
    """Rows are dicts; what they leave out is the usual night of lodge F1."""
    usual = dict(property_code="F1", booking_ref="fj-1", stay_status="OK", checkin="07.11.2030", checkout="09.11.2030",
                 stay_night="07.11.2030", room_code="HUT", currency="EUR", room_gross_eur="121", room_vat_eur="11",
                 board_gross_eur="")
    return "\n".join([",".join(header)] + [",".join((usual | r).get(h, "x") for h in header) for r in rows]) + "\n"


NORDIC_CSV = nordic_csv({}, {"stay_night": "8.11.2030", "board_gross_eur": "17.30"},
                        {"booking_ref": "fj-2", "stay_status": "cxl", "checkout": "08.11.2030"})


def cloud_doc(**change) -> dict:
    one = {"propertyId": "C4", "confirmationId": "zz-31", "reservationStatus": "checkedIn", "arrival": "2030-06-30",
           "departure": "2030-07-02", "createdAt": "2030-05-01T23:10:05+02:00", "modifiedAt": "2030-05-03T00:20:00+02:00",
           "ratePlanCode": "FLEX", "nightlyRates": [
               {"roomCode": "LOFT", "stayDate": d, "ratePlan": "FLEX", "roomChargeGross": "93.5", "roomChargeNet": "85",
                "incidentalsGross": None, "incidentalsNet": None} for d in ("2030-06-30", "2030-07-01")]}
    return {"reservations": [one | change]}


EVENTS = [booking(f"n{i}", [("QN", 10, 11, f"{70 + i}.125")]) for i in range(3)]


def ids(df):
    return sorted(r["reservation_id"] for r in df.collect())


def test_native_leaves_stay_text(spark, write_text):
    path = write_text("n.json", '{"data": [{"hotel_id": 88, "reservation_id": "x", "stay_dates": [{"room_revenue_net_amount": 45.10}]},'
                                ' {"hotel_id": "89", "stay_dates": []}]}')
    a, b = sorted(read_native(spark, path).collect(), key=lambda r: r["hotel_id"])
    assert (a["hotel_id"], a["stay_dates"][0]["room_revenue_net_amount"]) == ("88", "45.10")
    assert b["stay_dates"] == [] and b["reservation_id"] is None


def test_both_json_shapes_give_the_same_rows(spark, write_json, write_text):
    doc = write_json("e.json", {"data": EVENTS})
    lines = write_text("e.ndjson", "\n".join(map(json.dumps, EVENTS)))
    whole = read_native(spark, doc)
    split = load_all(spark, {"native": lines}, envelope=False)["native"]
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))
    assert load_raw(spark, lines, envelope=False) == 3


def test_any_path_that_spark_reads(spark, tmp_path, write_json):
    for i, e in enumerate(EVENTS):
        write_json(f"part{i}.json", {"data": [e]})
    (tmp_path / "nordic.csv").write_text(NORDIC_CSV)
    feeds = load_all(spark, {"native": f"{tmp_path}/part*.json", "nordic": f"file://{tmp_path}/nordic.csv"})
    assert ids(feeds["native"]) == ["n0", "n1", "n2"]
    assert feeds["nordic"].count() == 3 and feeds["cloud"].isEmpty()


@pytest.mark.parametrize("source", ["native", "nordic", "cloud"])
def test_a_given_path_must_exist(spark, tmp_path, write_json, source):
    paths = {"native": write_json("n.json", {"data": EVENTS}), source: f"{tmp_path}/nothing-*.here"}
    with pytest.raises(FileNotFoundError):
        load_all(spark, paths)


def test_native_is_required_and_the_others_are_not(spark, write_json):
    feeds = load_all(spark, {"native": write_json("n.json", {"data": []}), "nordic": None})
    assert {k: v.count() for k, v in feeds.items()} == {"native": 0, "nordic": 0, "cloud": 0}
    assert feeds["nordic"].columns == HEADER
    with pytest.raises(FileNotFoundError):
        load_all(spark, {"cloud": None})


@pytest.mark.parametrize("text", [
    json.dumps({"data": EVENTS})[:-30],              # cut off
    "\n".join(map(json.dumps, EVENTS)),              # lines, read as one document
    '{"data": [{"stay_dates": "none"}]}',            # wrong shape
])
def test_a_feed_that_does_not_parse_fails(spark, write_text, text):
    # a failing task reaches the driver as the JVM's error or as PySpark's own
    with pytest.raises(Exception, match=DOES_NOT_PARSE):
        read_native(spark, write_text("bad.json", text)).collect()


def test_a_line_that_does_not_parse_fails(spark, write_text):
    path = write_text("bad.ndjson", json.dumps(EVENTS[0]) + "\n" + json.dumps(EVENTS[1])[:-9] + "\n")
    with pytest.raises(Exception, match=DOES_NOT_PARSE):
        read_native(spark, path, envelope=False).collect()


def test_csv_columns_are_found_by_name(spark, write_text):
    usual = read_nordic(spark, write_text("a.csv", NORDIC_CSV)).collect()
    moved = [HEADER[1], HEADER[0], "remark", *HEADER[2:]]
    rows = ({}, {"stay_night": "8.11.2030", "board_gross_eur": "17.30"},
            {"booking_ref": "fj-2", "stay_status": "cxl", "checkout": "08.11.2030"})
    assert read_nordic(spark, write_text("b.csv", nordic_csv(*rows, header=moved))).collect() == usual
    assert usual[0]["property_code"] == "F1"
    with pytest.raises(ValueError, match="checkout"):
        read_nordic(spark, write_text("c.csv", nordic_csv({}, header=[h for h in HEADER if h != "checkout"])))


def test_a_short_csv_row_fails(spark, write_text):
    with pytest.raises(Exception, match=DOES_NOT_PARSE):
        read_nordic(spark, write_text("a.csv", NORDIC_CSV + "F1,fj-9,OK\n")).collect()


def test_nordic_nights_become_bookings(spark, write_text):
    raw = read_nordic(spark, write_text("a.csv", NORDIC_CSV))
    got = {r["reservation_id"]: r for r in adapters.adapt_nordic(raw).collect()}
    items = {"fj-1": [], "fj-2": []}
    for r in adapters.nordic_items(raw).orderBy("sd.start_date").collect():
        items[r["reservation_id"]].append(r["sd"])
    two = got["fj-1"]
    assert two["is_valid"] and two["status"] == "checked_in"
    assert (two["arrival_date"], two["departure_date"]) == (dt.date(2030, 11, 7), dt.date(2030, 11, 9))
    assert two["created_at"] == two["updated_at"] == dt.datetime(2030, 11, 7)
    assert two["stay_dates"] is None and two["n_items"] == 2
    assert [i["start_date"] for i in items["fj-1"]] == ["2030-11-07", "2030-11-08"]
    assert {Decimal(i["room_net"]) for i in items["fj-1"]} == {Decimal(110)}
    # 17.30 / 1.10 = 15.727272...
    assert [i["fnb_net"] and Decimal(i["fnb_net"]) for i in items["fj-1"]] == [None, Decimal("15.73")]
    assert got["fj-2"]["status"] == "cancelled" and got["fj-2"]["n_items"] == len(items["fj-2"]) == 1


def test_the_unified_feed_regroups_rows_without_a_key(spark, write_text, write_json):
    feeds = {"nordic": read_nordic(spark, write_text("a.csv", nordic_csv(*KEYLESS))), "cloud": read_cloud(spark, write_json("c.json", cloud_doc()))}
    got = [(r["source_system"], r["hotel_id"], r["reservation_id"], r["n_items"], r["is_valid"]) for r in adapters.unified_feed(feeds).collect()]
    assert sorted(got, key=str) == sorted([("nordic", "F1", "fj-1", 1, True), ("nordic", None, None, 2, False), ("nordic", "F1", None, 3, False),
                                           ("nordic", None, "fj-1", 1, False), ("cloud", "C4", "zz-31", 2, True)], key=str)


@pytest.mark.parametrize("raw,expected", [("ok", "checked_in"), (" Out", "checked_out"), ("CXL ", "cancelled"),
                                          ("NoShow", "confirmed"), ("Hold", "hold")])
def test_nordic_status_words(spark, raw, expected):
    night = spark.createDataFrame([{**dict.fromkeys(HEADER, "1"), "stay_status": raw}], NORDIC_ROW)
    assert adapters.nordic_nights(night).first()["status"] == expected


def test_rows_without_a_key_stay_apart(spark, write_text):
    nobody = {"property_code": "", "booking_ref": ""}
    df = adapters.adapt_nordic(read_nordic(spark, write_text("a.csv", nordic_csv({}, nobody, nobody | {"room_gross_eur": "5"}))))
    lost = df.filter(F.col("reservation_id").isNull()).collect()
    assert df.count() == 3 and [r["n_items"] for r in lost] == [1, 1] and not any(r["is_valid"] for r in lost)


KEYLESS = [{}, {"property_code": "", "booking_ref": ""}, {"property_code": "", "booking_ref": "", "room_gross_eur": "5", "checkout": "12.11.2030"},
           {"booking_ref": ""}, {"booking_ref": "", "stay_night": "08.11.2030"}, {"booking_ref": "", "stay_status": "cxl"}, {"property_code": ""}]


def test_rows_without_a_key_are_regrouped(spark, write_text):
    """As by GROUP BY (hotel, booking): a NULL id is a key like others, in the
    query's frame and in its SQL."""
    import duckdb
    from staylens.plans import oracle
    raw = read_nordic(spark, write_text("a.csv", nordic_csv(*KEYLESS)))
    df = adapters.adapt_nordic(raw, keyless_apart=False)
    assert adapters.adapt_nordic(raw).count() == 7
    got = {(r["hotel_id"], r["reservation_id"]): (r["n_items"], r["status"], r["departure_date"].day, r["is_valid"], r["items_md5"]) for r in df.collect()}
    assert df.count() == len(got) and {k: v[:4] for k, v in got.items()} == {
        ("F1", "fj-1"): (1, "checked_in", 9, True), (None, None): (2, "checked_in", 12, False), ("F1", None): (3, "cancelled", 9, False), (None, "fj-1"): (1, "checked_in", 9, False)}
    values = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in raw.collect())
    rows = duckdb.sql(f"WITH x_nor_raw AS (SELECT * FROM (VALUES {values}) AS t({', '.join(raw.columns)})), x_nor_n AS ({oracle.CTE['x_nor_n']}), x_nor AS ({oracle.CTE['x_nor']}) "
                      "SELECT hotel_id, reservation_id, len(stay_dates), status, day(departure_date) FROM x_nor").fetchall()
    assert sorted(map(str, rows)) == sorted(str((*k, *v[:3])) for k, v in got.items())


def test_cloud_snapshot(spark, write_json):
    r = adapters.adapt_cloud(read_cloud(spark, write_json("c.json", cloud_doc()))).first()
    assert r["is_valid"] and r["status"] == "checked_in"
    assert r["updated_at"] == dt.datetime(2030, 5, 3, 0, 20)
    assert [(i["start_date"], i["end_date"], i["room_net"]) for i in r["stay_dates"]] == [
        ("2030-06-30", "2030-06-30", "85"), ("2030-07-01", "2030-07-01", "85")]


def test_cloud_snapshots_are_ordered_by_instant(spark, write_json):
    """01:10 west of 01:50's zone is the later one, though its clock reads less."""
    from staylens.operators.reservations import dedup_latest
    doc = {"reservations": [cloud_doc(modifiedAt=at, reservationStatus=s)["reservations"][0] for at, s in (
        ("2030-11-03T01:50:00-04:00", "confirmed"), ("2030-11-03T01:10:00-05:00", "cancelled"))]}
    kept = dedup_latest(adapters.adapt_cloud(read_cloud(spark, write_json("c.json", doc)))).collect()
    assert [(r["status"], r["updated_at"]) for r in kept] == [("cancelled", dt.datetime(2030, 11, 3, 1, 10))]


@pytest.mark.parametrize("raw,expected", [("confirmed", "confirmed"), ("checkedOut", "checked_out"), ("  CANCELLED", "cancelled"),
                                          ("checkedout", "checkedout")])
def test_cloud_status_words(spark, write_json, raw, expected):
    df = adapters.adapt_cloud(read_cloud(spark, write_json("c.json", cloud_doc(reservationStatus=raw))))
    assert df.first()["status"] == expected


def test_sources_meet_by_column_name(spark, write_json, write_text):
    feeds = {"cloud": read_cloud(spark, write_json("c.json", cloud_doc())),
             "native": read_native(spark, write_json("n.json", {"data": EVENTS})),
             "nordic": read_nordic(spark, write_text("a.csv", NORDIC_CSV))}
    u = adapters.unified_feed(feeds)
    assert {r["source_system"]: r["count"] for r in u.groupBy("source_system").count().collect()} == {
        "native": 3, "nordic": 2, "cloud": 1}
    assert u.filter(~F.col("is_valid")).isEmpty()
