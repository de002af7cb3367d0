"""Reading one large enveloped JSON document in many tasks.

An envelope, ``{"data": [record, ...], ...}``, has no line ends that a reader
could split at: where a record starts depends on all that stands before, since
a brace may be inside a string. The text is therefore cut after any closing
brace, which Spark's own text reader does at byte ranges of the file, and

1. every task scans its pieces twice over, once as if they began inside a
   string and once as if not, and notes how each guess changes the depth of
   brackets and which lists of the wanted name open. The pieces are written as
   a table of chunks with these notes;
2. the notes of a file's ranges, a few numbers each, are run through in order:
   the true state at the start of every range;
3. every chunk is cut into records from its true state, by any task in any
   order. A record that runs over the end of a chunk comes out in parts, which
   are put together by file and place.

Strings, escapes, brackets and the commas of the list are followed byte for
byte; the records themselves are parsed by Spark. A document that ends too
early, has brackets that do not match, not exactly one list of that name in an
envelope, or an empty place in the list fails the read, as does a record that
does not parse.

The range states that are broadcast are one row per input split, which is what
the driver's own list of tasks holds as well.
"""

from __future__ import annotations

import json
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.session import ensure_checkpoint_dir

#: Bytes of pieces that are scanned and stored together.
CHUNK = 256 << 10
#: A chunk is a large row: a writer that looks at its buffers after every hundred
#: rows only, and row groups of the usual size, which a reader decodes as a whole,
#: would hold hundreds of MB a task.
_ROW_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "2", "parquet.block.size.row.check.min": "2"}
_SPLIT = b"}"
_STEP = np.zeros(256, np.int8)
_STEP[[*b"[{"]], _STEP[[*b"]}"]] = 1, -1
_MARK = _STEP != 0
_MARK[ord(",")] = True


def _scan(text: bytes):
    """(bytes, positions of the quotes that begin or end strings, positions of
    brackets and commas wherever they are). The text begins after a brace, so
    no escape is open there."""
    b = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(b == 0x22)
    at = quotes[(quotes > 0) & (b[np.maximum(quotes - 1, 0)] == 0x5C)]
    if len(at):
        run, back = np.zeros(len(at), np.int64), at - 1
        live = np.ones(len(at), bool)
        while live.any():  # as often as the longest row of backslashes
            run[live] += 1
            back -= 1
            live &= (back >= 0) & (b[np.maximum(back, 0)] == 0x5C)
        quotes = np.setdiff1d(quotes, at[run % 2 == 1], assume_unique=True)
    return b, quotes, np.flatnonzero(_MARK[b])


class _Events:
    """Brackets and commas outside strings with the depth before each (counted
    from the start of the text) and whether a bracket opens the wanted list."""

    def __init__(self, text: bytes, scanned, key: bytes, in_string: int):
        b, quotes, marks = scanned
        outside = (np.searchsorted(quotes, marks) & 1) ^ in_string == 0
        self.at = marks[outside]
        self.char = b[self.at]
        self.step = _STEP[self.char].astype(np.int64)
        self.depth = np.cumsum(self.step) - self.step
        self.wanted = np.zeros(len(self.at), bool)
        for m in re.finditer(rb'"' + re.escape(key) + rb'"\s*:\s*\[', text):
            i = int(np.searchsorted(quotes, m.start()))
            if i < len(quotes) and quotes[i] == m.start() and (i & 1) ^ in_string == 0:
                self.wanted[np.searchsorted(self.at, m.end() - 1)] = True


class _Notes:
    """How a range of text, begun inside a string or not, goes on: the change of
    depth, and by depth of an opening bracket (from the start of the range) how
    many opened, how many of them the wanted list, and whether the last did."""

    def __init__(self):
        self.change = [0, 0]
        self.levels: list[dict[int, list]] = [{}, {}]
        self.parity = 0

    def add(self, text: bytes, key: bytes) -> None:
        scanned = _scan(text)
        for guess in (0, 1):
            e = _Events(text, scanned, key, guess ^ self.parity)
            opens = e.step == 1
            depth, wanted = e.depth[opens] + self.change[guess], e.wanted[opens]
            for level in np.unique(depth):
                here = wanted[depth == level]
                old = self.levels[guess].get(int(level), [0, 0, False])
                self.levels[guess][int(level)] = [old[0] + len(here), old[1] + int(here.sum()), bool(here[-1])]
            self.change[guess] += int(e.step.sum())
        self.parity ^= len(scanned[1]) & 1

    def dump(self) -> str:
        return json.dumps([self.parity, self.change, [sorted(x.items()) for x in self.levels]])


def _chunks(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The document's text in chunks (file, size, block, seq, text, before,
    after): ``before`` and ``after`` are the notes of the range up to the chunk's
    start and end."""
    pieces = (spark.read.option("lineSep", _SPLIT.decode()).text(path)
              .select(F.concat("value", F.lit(_SPLIT.decode())).alias("value"), F.col("_metadata.file_path").alias("file"),
                      F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block")))
    name = key.encode()

    def emit(batches):
        now, seq, notes, held, length = None, 0, _Notes(), [], 0

        def flush():
            nonlocal seq, held, length
            text, before = b"".join(held), notes.dump()
            notes.add(text, name)
            row = {"file": [now[0]], "size": [now[1]], "block": [now[2]], "seq": pa.array([seq], pa.int32()), "text": pa.array([text], pa.binary()), "before": [before], "after": [notes.dump()]}
            seq, held, length = seq + 1, [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("file", "size", "block")]
            for value, *place in zip(batch["value"], *columns):
                if place != now:
                    if held:
                        yield flush()
                    now, seq, notes = place, 0, _Notes()
                raw = value.as_buffer()
                held.append(raw)
                length += raw.size
                if length >= CHUNK:
                    yield flush()
        if held:
            yield flush()

    return pieces.mapInArrow(emit, "file string, size long, block long, seq int, text binary, before string, after string")


_STATES = "file string, block long, in_string int, depth int, in_list boolean, base int, cut boolean, error string"


def _follow(table: pa.Table) -> pa.Table:
    """True states at the start of a file's ranges, from the notes of each."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    total, size = sum(r["bytes"] for r in rows), rows[0]["size"]
    cut = total == size + 1  # the text does not end with a brace, though the last piece was given one
    base = {"{": 0, "[": 1}.get(rows[0]["first"], -1)
    in_string, depth, in_list, lists, envelopes = 0, 0, False, 0, 0
    out = []
    for r in rows:
        parity, change, levels = json.loads(r["after"])
        out.append({"file": r["file"], "block": r["block"], "in_string": in_string, "depth": depth, "in_list": in_list, "base": base,
                    "cut": cut and r is rows[-1], "error": None})
        for level, (opened, wanted, last) in levels[in_string]:
            envelopes += opened if level + depth == base else 0
            if level + depth == base + 1:
                lists, in_list = lists + wanted, last
        depth += change[in_string]
        in_string ^= parity
    depth += cut and not in_string
    error = (None if total in (size, size + 1) else "its size is not that of its text",
             "it is no JSON object or array of such" if base < 0 else None,
             "it is cut off" if in_string or depth else None,
             f"it has no list of that name in {envelopes - lists} of {envelopes} envelopes" if lists != envelopes else None)
    out[0]["error"] = next((e for e in error if e), None)
    return pa.Table.from_pylist(out, pa.schema([("file", pa.string()), ("block", pa.int64()), ("in_string", pa.int32()), ("depth", pa.int32()),
                                                ("in_list", pa.bool_()), ("base", pa.int32()), ("cut", pa.bool_()), ("error", pa.string())]))


#: A record as a whole, or its part at the end of a chunk, filling one, at the start of one.
WHOLE, BEGIN, WITHIN, END = 0, 1, 2, 3


def _cut_chunk(text: bytes, key: bytes, in_string: int, depth: int, in_list: bool, base: int, last: bool):
    """(kind, opener, closer, text) of the list's entries in a chunk that begins
    in this state. Opener and closer are the characters around an entry."""
    level = base + 2
    e = _Events(text, _scan(text), key, in_string)
    before = e.depth + depth
    if len(before) and (before + e.step).min() < 0:
        raise ValueError("brackets do not match")
    closes = e.step == -1
    for d, char in ((base + 1, "}"), (base, "]")):
        if (e.char[closes & (before == d)] != ord(char)).any():
            raise ValueError(f"brackets do not match: {char!r} is missing")
    here = ((e.char == ord(",")) | closes) & (before == level) | (e.step == 1) & (before == level - 1)
    begin, opener, going = (0, None, in_list) if in_list and depth >= level else (0, None, False)
    for at, char, step, wanted in zip(e.at[here].tolist(), e.char[here].tolist(), e.step[here].tolist(), e.wanted[here].tolist()):
        if step == 1:
            begin, opener, going = at + 1, "[", bool(wanted)
        elif going:
            if step == -1 and char != ord("]"):
                raise ValueError("brackets do not match: ']' is missing")
            yield WHOLE if opener else END, opener, chr(char), text[begin:at]
            begin, opener, going = at + 1, ",", step == 0
    if going:
        yield BEGIN if opener else WITHIN, opener, None, text[begin:]
    elif last:
        closed = e.at[before + e.step == 0]
        after = int(closed[-1]) + 1 if len(closed) else 0 if depth == 0 else len(text)
        if text[after:].strip(b" \t\r\n"):
            raise ValueError("there is text after the end")


def _entries(chunks: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Entries and parts of entries (file, block, seq, kind, opener, closer, value)."""
    name = key.encode()

    def cut(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a chunk at a time, whatever the size of the batch
                out: dict[str, list] = {c: [] for c in ("file", "block", "seq", "kind", "opener", "closer", "value")}
                row = batch.slice(i, 1).to_pylist()[0]
                if row["base"] is None:
                    raise ValueError(f"{row['file']} has changed while it was read")
                parity, change, levels = json.loads(row["before"])
                guess, text = row["in_string"], row["text"]
                final = row["cut"] and row["seq"] == row["last_seq"]
                passed = dict((lv, v) for lv, v in levels[guess]).get(row["base"] + 1 - row["depth"])
                try:
                    for kind, opener, closer, value in _cut_chunk(
                            text[:-1] if final else text, name, guess ^ parity, row["depth"] + change[guess],
                            row["in_list"] if passed is None else passed[2], row["base"], row["final_block"] and row["seq"] == row["last_seq"]):
                        for c, v in zip(out, (row["file"], row["block"], row["seq"], kind, opener, closer, value.decode())):
                            out[c].append(v)
                except ValueError as exc:
                    raise ValueError(f"{row['file']} does not parse: {exc}") from exc
                yield pa.RecordBatch.from_arrays([pa.array(out["file"], pa.string()), pa.array(out["block"], pa.int64()), pa.array(out["seq"], pa.int32()), pa.array(out["kind"], pa.int32()),
                                                  *[pa.array(out[c], pa.string()) for c in ("opener", "closer", "value")]], list(out))

    return (chunks.select("file", "block", "seq", "text", "before").join(F.broadcast(states), ["file", "block"], "left")
            .mapInArrow(cut, "file string, block long, seq int, kind int, opener string, closer string, value string"))


def read_records(spark: SparkSession, path: str, key: str, schema: T.StructType, root: str | None = None) -> DataFrame:
    """The records of the list ``key`` of every envelope at ``path``, in many
    tasks. Running it writes the chunks to ``root``, a folder of its own that is
    by default below the checkpoint folder, and follows the ranges; a document
    that is no whole envelope is a ``ValueError``. The rows are made of the
    chunks, the documents are not read again."""
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/envelope/{uuid.uuid4().hex}"
    written = _chunks(spark, path, key)
    written.write.options(**_ROW_GROUPS).parquet(f"{root}/chunks")
    chunks = spark.read.schema(written.schema).parquet(f"{root}/chunks")
    size = F.octet_length("text")
    first = F.when((F.col("block") == 0) & (F.col("seq") == 0), F.substring(F.ltrim(F.regexp_replace(F.decode(F.substring("text", 1, 4096), "UTF-8"), r"^[ \t\r\n]+", "")), 1, 1))
    ranges = chunks.groupBy("file", "size", "block").agg(F.max_by("after", "seq").alias("after"), F.sum(size).alias("bytes"), F.max("seq").alias("last_seq"), F.max(first).alias("first"))
    ranges.write.parquet(f"{root}/ranges")
    ranges = spark.read.schema(ranges.schema).parquet(f"{root}/ranges")
    states = ranges.groupBy("file").applyInArrow(lambda t: _follow(t), _STATES)
    last = ranges.groupBy("file").agg(F.max("block").alias("_end"))
    states = (states.join(ranges.select("file", "block", "last_seq"), ["file", "block"]).join(last, "file")
              .withColumn("final_block", F.col("block") == F.col("_end")).drop("_end"))
    states.write.parquet(f"{root}/states")
    states = spark.read.schema(states.schema).parquet(f"{root}/states")
    bad = states.where("error IS NOT NULL").select("file", "error").first()
    if bad:
        raise ValueError(f"{bad['file']} does not parse as an envelope with the list {key!r}: {bad['error']}")

    found = _entries(chunks, states.drop("error"), key)
    place = Window.partitionBy("file").orderBy("block", "seq", F.desc("kind"))
    parts = (found.where(F.col("kind") != WHOLE)
             .withColumn("_entry", F.sum(F.when(F.col("kind") == BEGIN, 1).otherwise(0)).over(place))
             .groupBy("file", "_entry").agg(
                 F.max("opener").alias("opener"), F.max("closer").alias("closer"),
                 F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "seq", (-F.col("kind")).alias("k"), "value"))), lambda p: p["value"]), "").alias("value")))
    columns = ["opener", "closer", "value"]
    entries = found.where(F.col("kind") == WHOLE).select(*columns).unionByName(parts.select(*columns))
    blank = F.trim(F.regexp_replace("value", r"[ \t\r\n]+", " "))
    # an empty list has one blank entry between its brackets
    entries = entries.where(~((blank == "") & (F.col("opener") == "[") & (F.col("closer") == "]")))
    odd = F.raise_error(F.concat(F.lit(f"an entry of {key!r} does not parse as a record: "), F.substring(blank, 1, 60))).cast("string")
    text = F.when(blank.startswith("{"), F.col("value")).when(blank != "null", odd)  # null: a record of nulls
    return entries.select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("_record")).select("_record.*")


#: Files that can only be read from their start.
_COMPRESSED = (".gz", ".bz2", ".deflate", ".zst", ".snappy", ".lz4")


def is_split(spark: SparkSession, path: str) -> bool:
    """Whether a file at ``path`` is larger than what Spark reads in one task
    (a compressed file can't be cut, so it is not)."""
    limit = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    conf, new_path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = spark.read.text(path).inputFiles()
    if any(f.lower().endswith(_COMPRESSED) for f in files):
        return False
    return any(p.getFileSystem(conf).getFileStatus(p).getLen() > limit for p in map(new_path, files))
