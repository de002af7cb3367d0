"""Chat formatting: layouts by fingerprint, the template's round trip, spans
and digests against plain Python."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylens.llm import chat

RECORDS = "conv_id long, turn long, record string"
TURNS = "conv_id long, turn long, part int, role string, text string, layout string"
CONTROL = ["###", "</turn>", "\\", ": ", "#", "<", "/turn>", "\n", "ü", "😀", "user", "### assistant: ", "</turn>\n"]


@pytest.mark.parametrize("record,layout,turns", [
    ({"prompt": "p", "completion": "c"}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"id": 5, "meta": {"a": [1]}, "completion": None, "prompt": "p"}, "prompt_completion", [("user", "p"), ("assistant", "")]),
    ({"prompt": "p", "response": 4}, "prompt_response", [("user", "p"), ("assistant", "4")]),
    ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "", "output": "o", "system": "s"}, "instruction", [("system", "s"), ("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}, None]}, "messages", None),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, "message_parts", [("user", "a\nb")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, "conversations", [("user", "a"), ("assistant", "b")]),
    ({"message": {"role": "gpt", "content": "a"}}, "nested_message", [("gpt", "a")]),
    ({"role": None, "text": None}, "turn", [("", "")]),
    ({"messages": []}, "messages", []),
])
def test_layouts(record, layout, turns):
    for text in (json.dumps(record), json.dumps(dict(reversed(record.items())))):
        got, _, _, found = chat.Reader().read(text)
        assert found.name == layout
        if turns is not None:
            assert chat.turns_of(got, found) == turns


def test_undeclared_layouts_have_none():
    for text in (None, "", "[1]", "5", "{}", '{"messages": [{"role": "user"}]}', '{"prompt": "a", "completion": "b", "rating": 1}', '{"messages": {"role": "a", "content": "b"}}'):
        assert chat.Reader().read(text)[3] is None
    with pytest.raises(ValueError, match="share the paths"):
        chat.fingerprints((*chat.LAYOUTS, chat.Layout("again", (chat.Turn("text", role_at="role"),))))


def test_no_path_is_another():
    assert chat.fingerprint(chat.paths_of({"a.b": 1})) != chat.fingerprint(chat.paths_of({"a": {"b": 1}}))
    assert chat.fingerprint(chat.paths_of({"a": [1]})) != chat.fingerprint(chat.paths_of({"a[]": 1}))


def _plain(turns):
    """{conv_id: digest row} by sorting everything."""
    out = {}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is None, t[1] or 0, t[2], t[3] or "", t[4] or ""))
        loss = "".join(t[4] or "" for t in own if t[3] == "assistant")
        said = "".join(f"{t[3] or ''}\n{t[4] or ''}\n" for t in own)
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _digested(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r)[1:5] for r in rows}
    assert len(out) == len(rows)
    return out


def _turns(seed, n):
    """Turns whose texts are made of control strings; a third are of one conversation."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 6)))
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, None, -7]), rng.choice([0, 1, 2, 3, None]), 0, rng.choice(["user", "assistant", "system", "a: b", None, word()]),
             rng.choice([word(), word(), None, "", "same"]), "x") for _ in range(n)]
    return [(c, t, p, r, x, y) for c, t, p, r, x, y in rows] + rows[:5]


@pytest.mark.parametrize("chunk", [1, 40, chat.CHUNK])
def test_what_is_formatted_reads_back(spark, chunk):
    # no ties between unlike turns: their order is that of the formatted text
    turns, seen = [], {}
    for c, t, p, r, x, y in _turns(3, 300):
        n = seen.setdefault((c, t), {}).setdefault((r, x), len(seen[c, t]))
        turns.append((c, t, n, r, x, y))
    df = spark.createDataFrame(turns, TURNS).repartition(7).withColumns({c: F.lit(1) for c in ("segment", "spans", "chunk", "head", "body")})
    formatted = chat.assemble(chat.segments(df), chunk).cache()
    assert _digested(chat.digest(formatted)) == _plain(turns)
    if chunk == 1:
        assert formatted.count() == len(turns)
    for row in formatted.collect():
        for role, said in chat.read_back(row["text"]):
            pass
        assert all(0 <= s["start"] <= s["stop"] <= len(row["text"]) for s in row["spans"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CONTROL), max_size=12).map("".join), st.lists(st.sampled_from(CONTROL), max_size=5).map("".join))
def test_control_strings_never_occur_inside(text, role):
    import re
    escaped = re.sub(chat._CONTROL, r"\\\g<0>", text)
    assert "###" not in escaped and "</turn>" not in escaped and chat.unescape(escaped) == text
    head = chat.OPEN + re.sub(chat._CONTROL + "|:", r"\\\g<0>", role) + chat.COLON
    assert list(chat.read_back((head + escaped + chat.CLOSE) * 2)) == [(role, text)] * 2


def test_records_to_digests(spark):
    rows = [(1, None, json.dumps({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "### b"}]})),
            (2, 0, json.dumps({"prompt": "p", "completion": "c" * 3_000_000})), (2, 1, json.dumps({"completion": "d", "prompt": None})),
            (3, 0, json.dumps({"messages": []})), (None, 0, json.dumps({"role": "assistant", "text": "\\"})), (None, 0, json.dumps({"role": "assistant", "text": "\\"}))]
    records = spark.createDataFrame(rows, RECORDS).withColumn("text", F.lit("mine")).withColumn("layout", F.lit(1))
    turns = chat.canonical_turns(records)
    assert sorted((r["conv_id"] or 0, r["turn"] or 0, r["part"], r["role"], r["layout"]) for r in turns.collect()) == sorted([
        (1, 0, 0, "user", "messages"), (1, 0, 1, "assistant", "messages"), (2, 0, 0, "user", "prompt_completion"), (2, 0, 1, "assistant", "prompt_completion"),
        (2, 1, 0, "user", "prompt_completion"), (2, 1, 1, "assistant", "prompt_completion"), (0, 0, 0, "assistant", "turn"), (0, 0, 0, "assistant", "turn")])
    got = _digested(chat.digest(chat.assemble(chat.segments(turns))))
    assert set(got) == {1, 2, None} and got[2][2] == 3_000_001 and got[None][0] == 2 and got[1][3] == hashlib.sha256(b"### b").hexdigest()


def test_unknown_layouts_are_reported_never_lost(spark):
    rows = [(1, 0, '{"role": "user", "text": "a"}'), (1, 1, '{"speaker": "x", "words": ["a"]}'), (1, 2, '{"words": [], "speaker": "y"}'), (1, 3, None), (1, 4, "{")]
    records = spark.createDataFrame(rows, RECORDS)
    with pytest.raises(Exception, match="no layout has the fingerprint"):
        chat.canonical_turns(records).collect()
    assert chat.canonical_turns(records, unknown="skip").count() == 1
    report = {(r["layout"], tuple(r["paths"])): r["records"] for r in chat.layout_report(records).collect()}
    assert report == {("turn", ("role", "text")): 1, (None, ("speaker", "words[]")): 2, (None, ()): 2}


def test_empty_tables(spark):
    turns = chat.canonical_turns(spark.createDataFrame([], RECORDS))
    assert chat.digest(chat.assemble(chat.segments(turns))).collect() == []
    assert chat.layout_report(spark.createDataFrame([], RECORDS)).collect() == []


def test_a_hot_conversation_is_formatted_by_many_tasks(spark):
    turns = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit(0).alias("part"), F.lit("user").alias("role"),
                                       F.col("id").cast("string").alias("text"))
    formatted = chat.assemble(chat.segments(turns)).cache()
    per = formatted.withColumn("n", F.size(F.split("text", "</turn>\n")) - 1)
    assert formatted.count() >= 3 and per.agg(F.max("n")).first()[0] < 10_000
    row = chat.digest(formatted).first()
    assert row["n_turns"] == 20_000 and row["turns_sha256"] == hashlib.sha256("".join(f"user\n{i}\n" for i in range(20_000)).encode()).hexdigest()
