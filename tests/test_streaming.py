"""Incremental landing: each new feed file is landed exactly once."""

import json

from staylens.sources import read_native
from staylens.streaming import land_stream

from helpers import booking


def _event(i):
    return booking(i, [("QN", 10, 10, "99.9")], (10, 11))


def test_land_stream_is_incremental(spark, tmp_path):
    inbox, zone, ckpt = tmp_path / "inbox", tmp_path / "zone", tmp_path / "ckpt"
    inbox.mkdir()
    (inbox / "a.json").write_text("\n".join(json.dumps(_event(i)) for i in range(3)))
    q = land_stream(spark, "native", str(inbox), str(zone), str(ckpt))
    q.awaitTermination(120)
    assert spark.read.parquet(str(zone)).count() == 3
    (inbox / "b.json").write_text(json.dumps(_event(9)))
    q = land_stream(spark, "native", str(inbox), str(zone), str(ckpt))
    q.awaitTermination(120)
    landed = spark.read.parquet(str(zone))
    assert sorted(r["reservation_id"] for r in landed.collect()) == ["0", "1", "2", "9"]
    assert landed.first()["stay_dates"][0]["room_revenue_net_amount"] == "99.9"


def test_land_stream_envelope_matches_batch_reader(spark, tmp_path):
    inbox, zone = tmp_path / "inbox", tmp_path / "zone"
    inbox.mkdir()
    doc = {"data": [_event(1), _event(2)]}
    (inbox / "doc.json").write_text(json.dumps(doc))
    q = land_stream(spark, "native", str(inbox), str(zone), str(tmp_path / "ckpt"), envelope=True)
    q.awaitTermination(120)
    batch = read_native(spark, str(inbox / "doc.json"))
    assert sorted(map(tuple, spark.read.parquet(str(zone)).collect())) == sorted(map(tuple, batch.collect()))


def test_land_stream_nordic_csv(spark, tmp_path):
    from staylens.sources import read_nordic
    from test_sources import NORDIC_CSV

    inbox, zone = tmp_path / "inbox", tmp_path / "zone"
    inbox.mkdir()
    (inbox / "nordic.csv").write_text(NORDIC_CSV)
    q = land_stream(spark, "nordic", str(inbox), str(zone), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    batch = read_nordic(spark, str(inbox / "nordic.csv"))
    landed = spark.read.parquet(str(zone))
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, batch.collect()))
    assert landed.count() == 3
