"""Served report: golden CSVs round-trip through fact -> report -> CSV sink,
the file-name rule, the end-to-end job, and partitioned mart tables."""

import csv
import datetime as dt
import glob
import json
import os
from decimal import Decimal

import pytest

from staylens.operators import kpis
from staylens.plans import job
from staylens.sinks import VersionedTable, read_table, report_file_name, write_report_csv, write_table
from staylens.sinks.files import month_filter

from helpers import LODGE, LODGE_REPORT, lodge_events

GOLDEN = sorted(glob.glob(os.path.join(os.path.dirname(__file__), "fixtures", "golden", "*.csv")))
# Room capacity of the hotels in the golden reports.
CAPACITY = {"1035": 14, "2050": 15, "3120": 25, "3121": 25}


def golden_nights(hotel, path):
    """Night rows reproducing a golden report: k occupying rows (one carries
    the revenue), or one cancelled row when only revenue is present."""
    rows = []
    cap = CAPACITY[hotel]
    for rec in csv.DictReader(open(path)):
        night = dt.date.fromisoformat(rec["NIGHT_OF_STAY"])
        k = int((Decimal(rec["OCCUPANCY_PERCENTAGE"]) * cap / 100).quantize(Decimal(1)))
        rev = Decimal(rec["TOTAL_NET_REVENUE"])
        if k == 0 and rev:
            rows.append((hotel, f"c{night}", night, "cancelled", False, "X", rev))
        for i in range(k):
            rows.append((hotel, f"r{night}-{i}", night, "confirmed", True, "X", rev if i == 0 else Decimal(0)))
    return rows


@pytest.mark.parametrize("path", GOLDEN, ids=os.path.basename)
def test_golden_report_round_trip(spark, tmp_path, path):
    hotel = os.path.basename(path).split("_")[1]
    nights = spark.createDataFrame(golden_nights(hotel, path),
                                   "hotel_id string, reservation_id string, night date, status string, "
                                   "counts_for_occupancy boolean, room_type_id string, total_net_revenue decimal(19,6)")
    cap = spark.createDataFrame([(hotel, CAPACITY[hotel])], "hotel_id string, total_rooms long")
    report = kpis.kpi_report(kpis.daily_kpis(nights, cap), hotel, "2026-05-01", "2026-05-31")
    name = report_file_name(hotel, "2026-05-01", "2026-05-31")
    assert name == os.path.basename(path)
    out = write_report_csv(report, str(tmp_path), name)
    assert open(out).read() == open(path).read()


def test_report_file_name():
    assert report_file_name("1035", "2026-05-01", "2026-05-31") == "kpi_1035_2026_05_01_to_2026_05_31.csv"
    assert report_file_name("H", dt.date(2026, 1, 2), dt.date(2026, 1, 3)) == "kpi_H_2026_01_02_to_2026_01_03.csv"


def test_job_end_to_end(spark, tmp_path, write_json, write_text):
    native = write_json("native.json", {"data": lodge_events()})
    inv = write_text("inventory.csv", f"quantity,hotel_id,room_type_id\n3,{LODGE},QN\n5,{LODGE},TW\n-1,{LODGE},XY\n")
    args = job.parse_args(["--hotel-id", LODGE, "--from-date", "2031-03-10", "--to-date", "2031-03-13",
                           "--native", native, "--inventory", inv, "--output-dir", str(tmp_path / "out"),
                           "--marts-dir", str(tmp_path / "marts")])
    path = job.run(spark, args)
    assert os.path.basename(path) == f"kpi_{LODGE}_2031_03_10_to_2031_03_13.csv"
    assert open(path).read().splitlines() == [
        "NIGHT_OF_STAY,OCCUPANCY_PERCENTAGE,TOTAL_NET_REVENUE,ADR", *[",".join(map(str, r)) for r in LODGE_REPORT]]
    fact = read_table(spark, str(tmp_path / "marts" / "fct_daily_kpis"))
    assert fact.count() == 3 and "night_month" in fact.columns
    assert read_table(spark, str(tmp_path / "marts" / "kpi_report")).count() == 4


def test_job_reads_ndjson(spark, tmp_path, write_text):
    native = write_text("native.ndjson", "\n".join(map(json.dumps, lodge_events())))
    inv = write_text("inventory.csv", f"hotel_id,room_type_id,quantity\n{LODGE},QN,3\n{LODGE},TW,5\n")
    args = job.parse_args(["--hotel-id", LODGE, "--from-date", "2031-03-12", "--to-date", "2031-03-12", "--ndjson",
                           "--native", native, "--inventory", inv, "--output-dir", str(tmp_path / "out")])
    assert open(job.run(spark, args)).read().splitlines()[1] == ",".join(map(str, LODGE_REPORT[1]))


def test_job_runs_checks(spark, tmp_path, write_json, write_text, capsys):
    native = write_json("native.json", {"data": lodge_events()})
    inv = write_text("inventory.csv", f"hotel_id,room_type_id,quantity\n{LODGE},QN,3\n{LODGE},TW,5\n")
    base = ["--hotel-id", LODGE, "--from-date", "2031-03-10", "--to-date", "2031-03-13",
            "--native", native, "--run-checks"]
    job.run(spark, job.parse_args([*base, "--inventory", inv, "--output-dir", str(tmp_path / "ok")]))
    assert "checks: 0 failing" in capsys.readouterr().out
    # zero capacity: coverage reads 100 %, which the bounds check flags
    bad = write_text("inv_bad.csv", f"hotel_id,room_type_id,quantity\n{LODGE},QN,0\n")
    args = job.parse_args([*base, "--inventory", bad, "--output-dir", str(tmp_path / "bad")])
    with pytest.raises(SystemExit):
        job.run(spark, args)
    assert "FAIL data_availability.availability_pct_bounded" in capsys.readouterr().out


def test_job_rejects_bad_dates():
    with pytest.raises(SystemExit):
        job.parse_args(["--hotel-id", "H", "--from-date", "2026-05-03", "--to-date", "2026-05-01",
                        "--native", "x", "--inventory", "y", "--output-dir", "z"])
    with pytest.raises(SystemExit):
        job.parse_args(["--hotel-id", "H", "--from-date", "2026-13-01", "--to-date", "2026-05-01",
                        "--native", "x", "--inventory", "y", "--output-dir", "z"])


def test_partitioned_fact_and_incremental_overwrite(spark, tmp_path):
    rows = [("H", dt.date(2026, 4, 30), 1), ("H", dt.date(2026, 5, 1), 2), ("G", dt.date(2026, 5, 2), 3)]
    df = spark.createDataFrame(rows, "hotel_id string, night date, occupied_rooms long")
    path = str(tmp_path / "fact")
    write_table(df, path, by_night=True)
    assert set(VersionedTable(spark, path).commit().folders) == {"2026-04", "2026-05"}
    update = spark.createDataFrame([("H", dt.date(2026, 5, 1), 9)], "hotel_id string, night date, occupied_rooms long")
    write_table(update, path, by_night=True, incremental=True)
    got = {(r["hotel_id"], str(r["night"])): r["occupied_rooms"] for r in read_table(spark, path).collect()}
    # the night is replaced, the month's other nights and hotels stay
    assert got == {("H", "2026-04-30"): 1, ("H", "2026-05-01"): 9, ("G", "2026-05-02"): 3}
    may = read_table(spark, path).where(month_filter("2026-05-01", "2026-05-31"))
    assert may.count() == 2
