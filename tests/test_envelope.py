"""An enveloped document that is read in ranges gives the rows of one that is
read at once, and fails where that fails."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylens.schemas import NATIVE_ENVELOPE, NATIVE_EVENT
from staylens.sources import envelope, load_all, read_cloud, read_native

from helpers import booking
from test_sources import cloud_doc

NASTY = ['a"b', "x}y", "{[", "]}", "\\", 'q\\"', "},{", '"data": [', "ü😀", "\n", "tab\t", '\\\\"}', "", "null", "," * 5]


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few records and smaller chunks."""
    old, chunk = spark.conf.get("spark.sql.files.maxPartitionBytes"), envelope.CHUNK
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    envelope.CHUNK = 1000
    yield
    envelope.CHUNK = chunk
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _events(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        e = booking(f"n{i}", [("QN", 10, 11, "7")] * rng.randint(0, 4))
        for k in ("status", "hotel_id", "created_at"):
            if rng.random() < 0.5:
                e[k] = "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 6)))
        if rng.random() < 0.1:
            e["stay_dates"] = None
        if rng.random() < 0.2:
            e["data"] = [{"data": [1, {"data": ["}"]}]}]
        if rng.random() < 0.1:
            e["status"] = rng.choice(["w" * 3000, 17.50])
        out.append(e)
    return out


def _whole(spark, path):
    return spark.read.option("mode", "FAILFAST").schema(NATIVE_ENVELOPE).option("multiLine", True).json(path).select(F.inline("data"))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed,indent,ascii_only", [(1, None, True), (2, 2, False)])
def test_ranges_give_the_rows_of_the_whole(spark, small_ranges, write_text, seed, indent, ascii_only):
    events = _events(seed, 60)
    around = [({"data": events}), ({"meta": {"n": "}", "other": [{"x": 1}, [2]]}, "data": events, "after": [{"data": "x"}, "]}"]})][seed % 2]
    path = write_text("big.json", json.dumps(around, indent=indent, ensure_ascii=ascii_only) + ("\n" if seed == 2 else ""))
    assert envelope.is_split(spark, path)
    split = read_native(spark, path)
    assert split.rdd.getNumPartitions() > 1
    got = _rows(split)
    assert got == _rows(_whole(spark, path)) and len(got) == 60


def test_array_of_envelopes_and_empty_lists(spark, small_ranges, write_text):
    docs = [{"data": _events(5, 12), "n": 1}, {"data": []}, {"x": ["}"], "data": _events(6, 9)}]
    path = write_text("many.json", "  " + json.dumps(docs))
    assert _rows(read_native(spark, path)) == _rows(_whole(spark, path))
    pad = "p" * 4000
    for text in (f'{{"pad": "{pad}", "data": []}}', f'{{"pad": "{pad}", "data" : [ \n ] }}  '):
        assert read_native(spark, write_text("none.json", text)).collect() == []
    path = write_text("null.json", f'{{"pad": "{pad}", "data": [null, {{"hotel_id": 5}}]}}')
    assert _rows(read_native(spark, path)) == _rows(_whole(spark, path))


def test_cloud_envelopes_and_several_files(spark, small_ranges, tmp_path, write_json):
    one = cloud_doc()["reservations"][0]
    for i in range(3):
        write_json(f"c{i}.json", {"reservations": [one | {"confirmationId": f"{i}-{k}"} for k in range(1 + 12 * i)]})
    got = read_cloud(spark, f"{tmp_path}/c*.json")
    assert sorted(r["confirmationId"] for r in got.collect()) == sorted(f"{i}-{k}" for i in range(3) for k in range(1 + 12 * i))
    feeds = load_all(spark, {"native": write_json("n.json", {"data": _events(8, 20)}), "cloud": f"{tmp_path}/c*.json"})
    assert feeds["native"].count() == 20 and feeds["cloud"].count() == 39


def _in_ranges(text: bytes, rng) -> list[str]:
    """The three steps on one text, without Spark: cut after random braces into
    ranges and chunks, follow the ranges, cut every chunk into entries."""
    pieces = [p + b"}" for p in text.split(b"}")]
    if text.endswith(b"}"):
        pieces.pop()
    ranges, at = [], 0
    for p in pieces:
        if not ranges or rng.random() < 0.2:
            ranges.append((at, []))
        if not ranges[-1][1] or rng.random() < 0.3:
            ranges[-1][1].append(b"")
        ranges[-1][1][-1] += p
        at += len(p)
    told, chunks = [], []
    for block, own in ranges:
        notes = envelope._Notes()
        for seq, chunk in enumerate(own):
            chunks.append((block, seq, chunk, notes.dump()))
            notes.add(chunk, b"data")
        first = text.lstrip(b" \t\r\n")[:1].decode() if block == 0 else None
        told.append({"file": "f", "size": len(text), "block": block, "bytes": sum(map(len, own)), "after": notes.dump(), "first": first})
    rng.shuffle(told)
    states = {r["block"]: r for r in envelope._follow(pa.Table.from_pylist(told)).to_pylist()}
    for r in states.values():
        if r["error"]:
            raise ValueError(r["error"])
    entries, last = [], chunks[-1][:2]
    for block, seq, chunk, before in chunks:
        s = states[block]
        parity, change, levels = json.loads(before)
        passed = dict((lv, v) for lv, v in levels[s["in_string"]]).get(s["base"] + 1 - s["depth"])
        end = (block, seq) == last
        for kind, opener, closer, value in envelope._cut_chunk(
                chunk[:-1] if end and s["cut"] else chunk, b"data", s["in_string"] ^ parity, s["depth"] + change[s["in_string"]],
                s["in_list"] if passed is None else passed[2], s["base"], end):
            if kind in (envelope.WHOLE, envelope.BEGIN):
                entries.append([opener, closer, value])
            else:
                entries[-1] = [entries[-1][0], closer, entries[-1][2] + value]
    entries = [v.strip().decode() for o, c, v in entries if v.strip() or (o, c) != ("[", "]")]
    if not all(e.startswith("{") or e == "null" for e in entries):
        raise ValueError("no record")
    return entries


@pytest.mark.parametrize("seed", range(40))
def test_any_ranges_give_the_entries(seed):
    rng = random.Random(seed)
    docs = [{"other": {"data": ["}"], "n": "]}"}, "data": _events(seed + i, rng.randint(0, 6)), "data2": [{"data": [{}]}]} for i in range(rng.choice([1, 1, 3]))]
    value = docs[0] if len(docs) == 1 else docs
    text = json.dumps(value, indent=rng.choice([None, 1]), ensure_ascii=seed % 2 == 0).encode() + rng.choice([b"", b"\n", b" "])
    assert [json.loads(e) for e in _in_ranges(text, rng)] == [e for d in docs for e in d["data"]]


PAD = json.dumps(_events(9, 12))[1:-1]
BAD = [
    f'{{"data": [{PAD}]',                          # one brace short
    f'{{"data": [{PAD}]}}}}',                      # one too many
    f'{{"data": [{PAD}'[:-40],                     # cut off inside a record
    f'{{"data": [{PAD}, "open]}}',                 # a string without an end
    f'{{"data": [{PAD},]}}', f'{{"data": [,{PAD}]}}', f'{{"data": [{PAD},,{{}}]}}',
    f'{{"data": [{PAD}}}}}', f'{{"data": [{PAD}]]',
    f'{{"data": [{PAD}, 5]}}', f'{{"data": [{PAD}, [{{}}]]}}',
    f'{{"data": [{PAD}]}} and more',
    f'{{"data": {{"data": [{PAD}]}}}}',            # the list is not the envelope's
    f'{{"data": [{PAD}], "data": [{PAD}]}}',
    f'{{"other": [{PAD}]}}', f'{{"data": null, "other": [{PAD}]}}',
    "\n".join(map(json.dumps, _events(9, 12))),    # lines
    "x" * 2000,
]


@pytest.mark.parametrize("text", BAD)
def test_what_is_no_envelope_is_found_in_any_ranges(text):
    for seed in range(8):
        with pytest.raises(ValueError):
            _in_ranges(text.encode(), random.Random(seed))


@pytest.mark.parametrize("text", [BAD[0], BAD[2], BAD[6], BAD[16], f'{{"data": [{PAD}, {{"stay_dates": "none"}}]}}'])
def test_what_is_no_envelope_fails(spark, small_ranges, write_text, text):
    with pytest.raises(Exception, match="MALFORMED|does not parse"):
        read_native(spark, write_text("bad.json", text)).collect()


def test_ranges_share_the_work(spark, tmp_path):
    """Records of one document come out of many tasks, a third of its bytes in one record or not."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = str(tmp_path / "big.json")
    event = json.dumps(booking("x", [("QN", 10, 11, "7")] * 3))
    with open(path, "w") as f:
        f.write('{"data": [' + ",".join(event.replace('"x"', f'"x{i}"') for i in range(12_000)) + "]}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        split = read_native(spark, path)
        per_task = split.groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) >= 8 and sum(r["count"] for r in per_task) == 12_000
        assert split.select("reservation_id").distinct().count() == 12_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_scanning_follows_strings_and_escapes():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "a"]) for _ in range(rng.randint(0, 40))).encode()
        inside, skip, quotes = False, False, []
        for i, c in enumerate(text):
            if skip:
                skip = False
            elif c == 0x5C:
                skip = True
            elif c == 0x22:
                quotes.append(i)
        assert envelope._scan(text)[1].tolist() == quotes
    assert NATIVE_EVENT.names[0] == "hotel_id"


def test_chunks_are_stored_in_small_row_groups(spark, write_text):
    """What a task holds of the chunks, a row group, is bounded."""
    import glob
    import os

    import pyarrow.parquet as pq

    from staylens.session import ensure_checkpoint_dir
    event = booking("n", [("QN", 10, 11, "7")])
    path = write_text("large.json", json.dumps({"data": [event | {"reservation_id": f"n{i}", "status": "w" * 100_000} for i in range(400)]}))
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{top}/envelope/*"))
    assert envelope.read_records(spark, path, "data", NATIVE_EVENT).select("reservation_id").distinct().count() == 400
    folder, = set(glob.glob(f"{top}/envelope/*")) - before
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in glob.glob(os.path.join(folder, "chunks", "*.parquet"))
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert max(g.total_byte_size for g in groups) < 12 << 20 and sum(g.total_byte_size for g in groups) > 40_000_000


def test_documents_of_a_share_end_with_it(spark, monkeypatch):
    """The query's documents are written, read and removed share by share, with
    the rows of the feed, and nothing but landed feeds and records is left."""
    import os

    from staylens.plans import catalog
    feed = catalog.landed_feeds(spark, "/root/testdata/sf0.001")["native"]
    monkeypatch.setattr(catalog, "SHARE_BYTES", 1)
    assert len(catalog.shares(spark, feed.inputFiles(), 1)) == len(feed.inputFiles())
    assert catalog.shares(spark, feed.inputFiles(), 1 << 40) == [sorted(feed.inputFiles())]
    several = feed.repartition(3).write.mode("overwrite")
    with monkeypatch.context() as m:
        root = os.path.dirname(os.path.dirname(feed.inputFiles()[0].removeprefix("file:")))
        several.parquet(f"{root}/several")
        m.setitem(catalog._LANDED, (spark.sparkContext.applicationId, "/root/testdata/sf0.001"), {"native": spark.read.schema(feed.schema).parquet(f"{root}/several")})
        got = catalog.records_of_envelopes(spark, "/root/testdata/sf0.001")
    assert _rows(got) == _rows(feed) and got.count() > 1000
    left = os.path.dirname(os.path.dirname(got.inputFiles()[0].removeprefix("file:")))
    assert os.listdir(left) == ["records"] and len(got.inputFiles()) >= 3
    assert "events" not in os.listdir(root)
