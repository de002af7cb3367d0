"""The filter audit against a plain count over all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import audit

from llm_data import SCHEMA, clashing, prose

LABELS = "doc_id long, quality int, toxic int"


def _fails(text, smaller_twin):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    text = text or ""
    return {name for name, bad in (
        ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)), ("D", bool(re.search("[#$%&*|]", text))), ("E", smaller_twin)) if bad}


def _brute(rows, labels):
    docs = []
    for i, text, _, source, _ in rows:
        twin = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, *_ in rows)
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        docs.append((source or "", _fails(text, twin), any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [d for d in left if name in d[1]]
                failing = sum(name in d[1] for d in own)
                left = [d for d in left if name not in d[1]]
                shapley[part, name] += len(gone)
                out[part, "".join(order), step] = (len(left), len(gone), failing - len(gone), sum(d[1] == {name} for d in own),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _got(df):
    found = {}
    for r in df.collect():
        assert found.setdefault((r["part"], r["filter_order"], r["step"]), tuple(r)[3:]) == tuple(r)[3:]
    return found


@pytest.fixture(scope="module")
def rows(messy_rows):
    rng = random.Random(9)
    more = []
    for i in range(300, 360):
        text = prose(rng, rng.choice([5, 150, 220, 400]))
        if rng.random() < 0.3:
            text = " ".join(text.split()[:60] * 4)
        if rng.random() < 0.3:
            text = text.upper() if rng.random() < 0.5 else f"{text} 5 % | #"
        more.append((i, text, None, rng.choice(["s0", "s1", "", None]), 0))
    big = prose(rng, 230)
    more += [(400 + i, big, "ab", "hot" if i % 3 else "s1", 1) for i in range(30)] + [(None, big, "ab", "hot", 1), (None, big, None, None, 1), (400, big, "x", "hot", 1)]
    return messy_rows + more


def test_every_order_and_step(spark, rows):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 430, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1), (9999, 1, 1), (4, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = spark.createDataFrame(labels, LABELS)
    want = _brute(rows, labels)
    assert _got(audit.audit(docs, found)) == want
    assert _got(audit.audit(clashing(docs).select("*", *[F.lit(1).alias(c) for c in ("part", "failed", "own", "digest", "least", "n", "good", "toxic", "step")]),
                            found.withColumn("good", F.lit(7)).withColumn("n", F.lit(7)))) == want


def test_one_order_is_a_chain(spark, rows):
    """What a step keeps is what the step before kept, less what it removes."""
    docs = spark.createDataFrame(rows, SCHEMA)
    got = _got(audit.audit(docs, spark.createDataFrame([], LABELS)))
    total = Counter(r[3] or "" for r in rows)
    for (part, order, step), v in got.items():
        before = got[part, order, step - 1][0] if step > 1 else total[part]
        assert v[0] == before - v[1] and v[4:6] == (0, 0)
    assert len(got) == 600 * len(total)


def test_empty_tables(spark, nothing):
    empty = spark.createDataFrame([], LABELS)
    assert audit.audit(nothing, empty).collect() == []


def test_very_long_text_and_the_cut_of_batches():
    long = "word " * 400_000 + "Ab " * 900_000
    from staylens.llm.words import pieces, text_buffer
    import pyarrow as pa
    data, off = text_buffer(pa.array([long, None, "A", "a%"]))
    got = np.concatenate([audit.text_failures(d, o) for _, _, d, o in pieces(data, off, 1 << 16)])
    assert got.tolist() == [8 + 4, 16, 16 + 4, 16 + 2]
