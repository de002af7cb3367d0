"""Chat formatting by schema fingerprints.

Records come in many layouts: prompts with completions, instructions, lists of
messages, single turns. The nested field paths of a record, hashed, are its
fingerprint; the fingerprint selects a declarative `Layout`, which says where
turns, roles and texts stand; the result are canonical turns, whatever the
layout was. A record whose fingerprint no layout declares is never guessed at:
it fails the job or, if asked so, is left to `layout_report`.

Canonical turns are then formatted as

    ### role: text</turn>

one after the other, with the spans of the text to train on. Inside roles and
texts, a backslash stands before every backslash, every ``#`` of three or more
in a row, the slash of ``</turn>`` and (roles only) every colon, so control
strings never occur there and reading back is exact.

Formatting works on single turns and on ranges of (conversation, turn), so a
conversation with a third of all rows is formatted by many tasks and comes out
as many chunks. Only its digest is made in one task, as a hash over the whole
conversation must be; that task streams and holds one chunk at a time.

Defined results: a null text or role is empty; turns are ordered by turn (null
last), then by place in the record, then by formatted text; repeated rows are
turns of their own; rows without a conversation id are one conversation; a
record that is null or no JSON has no layout; an empty table gives an empty
result. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- layouts ---------------------------------------------------------------


@dataclass(frozen=True)
class Turn:
    """Where a turn stands: ``text`` names one path or several, whose values
    are joined by a blank line; ``role`` is a fixed role, ``role_at`` a path.
    With ``each`` there is a turn for every element of that array, and the
    paths start there. ``required=False``: no turn if all its texts are absent."""

    text: str | tuple[str, ...]
    role: str | None = None
    role_at: str | None = None
    each: str | None = None
    required: bool = True


@dataclass(frozen=True)
class Layout:
    """Turns in their order; ``optional`` paths may be absent; ``roles`` renames
    roles that are read from the record."""

    name: str
    turns: tuple[Turn, ...]
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


_SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))

LAYOUTS = (
    Layout("prompt_completion", (Turn("prompt", "user"), Turn("completion", "assistant"))),
    Layout("prompt_response", (Turn("system", "system", required=False), Turn("prompt", "user"), Turn("response", "assistant")), ("system",)),
    Layout("question_answer", (Turn(("context", "question"), "user"), Turn("answer", "assistant")), ("context",)),
    Layout("instruction", (Turn("system", "system", required=False), Turn(("instruction", "input"), "user"), Turn("output", "assistant")), ("system", "input")),
    Layout("messages", (Turn("content", role_at="role", each="messages[]"),)),
    Layout("message_parts", (Turn("content[].text", role_at="role", each="messages[]"),), ("messages[].content[].type",)),
    Layout("conversations", (Turn("system", "system", required=False), Turn("value", role_at="from", each="conversations[]")), ("system",), _SHARED),
    Layout("nested_message", (Turn("message.content", role_at="message.role"),)),
    Layout("turn", (Turn("text", role_at="role"),)),
    Layout("only_system", (Turn("system", "system"),)),
    Layout("only_prompt", (Turn("prompt", "user"),)),
    Layout("only_completion", (Turn("completion", "assistant"),)),
)
#: Fields that accompany a record and are no part of its layout.
BESIDE = ("id", "source", "lang", "meta", "metadata")

Path = tuple[str | None, ...]


def path(text: str) -> Path:
    """``messages[].role`` as its steps: keys, and None for an array's elements."""
    steps: list[str | None] = []
    for key in text.split("."):
        steps += [key.removesuffix("[]"), None] if key.endswith("[]") else [key]
    return tuple(steps)


def paths_of(value, at: Path = ()) -> set[Path]:
    """Paths of all leaves of a JSON value; an empty array or object is a leaf."""
    if isinstance(value, dict) and value:
        return set().union(*(paths_of(v, (*at, k)) for k, v in value.items()))
    if isinstance(value, list):
        return set().union({(*at, None)} if not value else set(), *(paths_of(v, (*at, None)) for v in value))
    return {at}


def fingerprint(paths: set[Path]) -> str:
    """Hash of a set of paths, whatever their order."""
    return hashlib.blake2b("\n".join(sorted(json.dumps(p) for p in paths)).encode(), digest_size=16).hexdigest()


def _declared(layout: Layout) -> tuple[set[Path], set[Path]]:
    """(required, optional) paths of a layout. Elements of an array may be null
    or, themselves arrays, empty."""
    need: set[Path] = set()
    for t in layout.turns:
        start = path(t.each) if t.each else ()
        need |= {(*start, *path(p)) for p in ([t.text] if isinstance(t.text, str) else t.text)} | ({(*start, *path(t.role_at))} if t.role_at else set())
    may = {path(p) for p in layout.optional}
    may |= {p[:i + 1] for p in need for i, step in enumerate(p[:-1]) if step is None}
    return need - may, may


def fingerprints(layouts=LAYOUTS) -> dict[str, Layout]:
    """All fingerprints that the layouts declare: the required paths with any of
    the optional ones. Layouts that share one are an error."""
    found: dict[str, Layout] = {}
    for layout in layouts:
        need, may = _declared(layout)
        for n in range(len(may) + 1):
            for more in combinations(sorted(may, key=str), n):
                if found.setdefault(key := fingerprint(need | set(more)), layout) is not layout:
                    raise ValueError(f"layouts {found[key].name} and {layout.name} share the paths {sorted(need | set(more), key=str)}")
    for layout in layouts:  # no element at all: no turn, whichever layout it is
        for t in layout.turns:
            if t.each:
                found.setdefault(fingerprint({path(t.each)}), layout)
    return found


def _values(value, steps: Path) -> list:
    if not steps:
        return [value]
    if steps[0] is None:
        return [x for v in (value if isinstance(value, list) else []) for x in _values(v, steps[1:])]
    return _values(value[steps[0]], steps[1:]) if isinstance(value, dict) and steps[0] in value else []


def _text(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of each turn of a record in its layout."""
    out, roles = [], dict(layout.roles)
    for t in layout.turns:
        for scope in _values(record, path(t.each)) if t.each else [record]:
            texts = [[_text(v) for v in _values(scope, path(p))] for p in ([t.text] if isinstance(t.text, str) else t.text)]
            if not t.required and not any(texts):
                continue
            role = t.role if t.role_at is None else _text(next(iter(_values(scope, path(t.role_at))), None))
            joined = [x for x in ("\n".join(v) for v in texts) if x]
            out.append((roles.get(role, role) if t.role_at else role, "\n\n".join(joined)))
    return out


class Reader:
    """Finds the layout of records by fingerprint."""

    def __init__(self, layouts=LAYOUTS, beside=BESIDE):
        self.known, self.beside = fingerprints(layouts), set(beside)

    def read(self, text: str | None):
        """(record, paths, fingerprint, layout or None) of a JSON text."""
        try:
            record = json.loads(text) if text is not None else None
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return None, set(), "", None
        paths = paths_of({k: v for k, v in record.items() if k not in self.beside})
        key = fingerprint(paths)
        return record, paths, key, self.known.get(key)


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def canonical_turns(records: DataFrame, layouts=LAYOUTS, unknown: str = "fail") -> DataFrame:
    """Canonical turns (conv_id, turn, part, role, text, layout) of ``records``
    (conv_id, turn, record: JSON text). ``part`` counts the turns inside a
    record. ``unknown``: a record without a layout fails the job ("fail") or
    gives no turn ("skip"); `layout_report` counts them."""
    if unknown not in ("fail", "skip"):
        raise ValueError(f"unknown must be 'fail' or 'skip', not {unknown!r}")
    schema = f"conv_id {_type(records, 'conv_id')}, turn {_type(records, 'turn')}, part int, role string, text string, layout string"

    def convert(batches):
        reader = Reader(layouts)
        for batch in batches:
            rows, part, role, text, name = [], [], [], [], []
            for i, raw in enumerate(batch["record"].to_pylist()):
                record, paths, key, layout = reader.read(raw)
                if layout is None:
                    if unknown == "fail":
                        raise ValueError(f"no layout has the fingerprint {key!r} of the paths {sorted(paths, key=str)}")
                    continue
                for k, (r, t) in enumerate(turns_of(record, layout)):
                    rows.append(i)
                    part.append(k)
                    role.append(r)
                    text.append(t)
                    name.append(layout.name)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"].take(at), batch["turn"].take(at), pa.array(part, pa.int32()), pa.array(role, pa.string()), pa.array(text, pa.string()),
                 pa.array(name, pa.string())], ["conv_id", "turn", "part", "role", "text", "layout"])

    return records.select("conv_id", "turn", "record").mapInArrow(convert, schema)


def layout_report(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """(fingerprint, layout, paths, records): how often each fingerprint occurs,
    with a null layout where none declares it."""

    def survey(batches):
        reader = Reader(layouts)
        for batch in batches:
            seen: dict[str, list] = {}
            for raw in batch["record"].to_pylist():
                _, paths, key, layout = reader.read(raw)
                names = sorted("".join("[]" if s is None else f".{s}" for s in p).lstrip(".") for p in paths)
                seen.setdefault(key, [layout and layout.name, names, 0])[2] += 1
            yield pa.RecordBatch.from_pydict({
                "fingerprint": pa.array(seen, pa.string()), "layout": pa.array([v[0] for v in seen.values()], pa.string()),
                "paths": pa.array([v[1] for v in seen.values()], pa.list_(pa.string())), "records": pa.array([v[2] for v in seen.values()], pa.int64())})

    return (records.select("record").mapInArrow(survey, "fingerprint string, layout string, paths array<string>, records long")
            .groupBy("fingerprint", "layout", "paths").agg(F.sum("records").alias("records")))


# --- template --------------------------------------------------------------

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
_CONTROL = r"\\|#(?=##)|(?<=#)#(?=#)|(?<=##)#|(?<=<)/(?=turn>)"
_HEADER = re.compile(re.escape(OPEN) + r"((?:[^\\:]|\\.)*)" + re.escape(COLON), re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def _escape(text: Column, more: str = "") -> Column:
    return F.regexp_replace(text, _CONTROL + more, r"\\$0")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segments(turns: DataFrame, trained=("assistant",)) -> DataFrame:
    """One formatted segment a turn: (conv_id, turn, part, segment, loss_start,
    loss_end), the span in code points inside the segment, null where the role
    is not one of ``trained``."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    made = turns.select("conv_id", "turn", "part", role.alias("role"), F.concat(F.lit(OPEN), _escape(role, "|:"), F.lit(COLON)).alias("head"),
                        _escape(text).alias("body"))
    learn = F.col("role").isin(*trained)
    start = F.length("head")
    return made.select("conv_id", "turn", "part", F.concat("head", "body", F.lit(CLOSE)).alias("segment"),
                       F.when(learn, start).alias("loss_start"), F.when(learn, start + F.length("body")).alias("loss_end"))


def _ordered(df: DataFrame, *more: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("conv_id", "turn", "part", *more)]


#: Code points after which a chunk of a conversation ends, between two turns.
CHUNK = 1 << 20


def assemble(segs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Formatted conversations (conv_id, turn, part, chunk, text, spans): text
    of consecutive turns with the spans to train on. A conversation is the
    chunks of its id by turn and part of their first turn, then chunk; most
    have a single one. Ranges of the sort key share the work, so chunks also
    end where a range does."""
    schema = f"conv_id {_type(segs, 'conv_id')}, turn {_type(segs, 'turn')}, part int, chunk int, text string, spans array<struct<start: int, stop: int>>"
    out_type = [pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))]

    def join(batches):
        now, number = None, 0
        texts, spans, length = [], [], 0
        done: list[tuple] = []

        def close():
            if texts:
                done.append((*now, number, "".join(texts), list(spans)))
            texts.clear()
            spans.clear()

        for batch in batches:
            for conv, turn, part, seg, a, b in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "part", "segment", "loss_start", "loss_end"))):
                if not texts or conv != now[0] or length >= chunk:
                    close()
                    number = number + 1 if now and conv == now[0] else 0
                    now, length = (conv, turn, part), 0
                if a is not None:
                    spans.append({"start": length + a, "stop": length + b})
                texts.append(seg)
                length += len(seg)
            yield emit(done, batch.schema)
            done.clear()
            last = batch.schema
        close()
        if done:
            yield emit(done, last)

    def emit(rows, schema):
        cols = list(zip(*rows)) or [[]] * 6
        kinds = [schema.field("conv_id").type, schema.field("turn").type, pa.int32(), pa.int32(), pa.string(), *out_type]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["conv_id", "turn", "part", "chunk", "text", "spans"])

    return (segs.repartitionByRange(*_ordered(segs)).sortWithinPartitions(*_ordered(segs, "segment")).mapInArrow(join, schema))


def read_back(text: str):
    """(role, text) of every turn of a formatted text; fails on anything else."""
    at = 0
    while at < len(text):
        head = _HEADER.match(text, at)
        end = text.find(CLOSE, head.end()) if head else -1
        if end < 0:
            raise ValueError(f"no turn at code point {at}")
        yield unescape(head[1]), unescape(text[head.end():end])
        at = end + len(CLOSE)


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from their text and
    spans: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars). A conversation is hashed in order by one task, a chunk at
    a time."""
    schema = f"conv_id {_type(formatted, 'conv_id')}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    class Tally:
        def __init__(self, conv):
            self.conv, self.n, self.loss, self.chars = conv, 0, 0, 0
            self.turns, self.trained = hashlib.sha256(), hashlib.sha256()

        def add(self, text, spans):
            for role, said in read_back(text):
                self.n += 1
                self.turns.update(f"{role}\n{said}\n".encode())
            for span in spans:
                said = unescape(text[span["start"]:span["stop"]])
                self.loss += len(said)
                self.trained.update(said.encode())
            self.chars += len(text)

        def row(self):
            return self.conv, self.n, self.turns.hexdigest(), self.loss, self.trained.hexdigest(), self.chars

    def emit(rows, kind):
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], names)

    def tally(batches):
        now = None
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch[c].to_pylist() for c in ("conv_id", "text", "spans"))):
                if now is None or conv != now.conv:
                    rows += [now.row()] if now else []
                    now = Tally(conv)
                now.add(text, spans)
            kind = batch.schema.field("conv_id").type
            yield emit(rows, kind)
        if now:
            yield emit([now.row()], kind)

    return (formatted.select("conv_id", "turn", "part", "chunk", "text", "spans").repartition("conv_id")
            .sortWithinPartitions(*_ordered(formatted, "chunk")).mapInArrow(tally, schema))
