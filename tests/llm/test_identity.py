"""Rows that are hard to tell apart, and columns named as an operator's own."""

import zlib

import pytest
from pyspark.sql import functions as F

from staylens.llm import decontaminate, embed_join, jaccard, mixing, substrings

from llm_data import SCHEMA


@pytest.fixture(scope="module")
def colliding():
    """Two texts of 40 words with nothing in common but their crc32."""
    seen = {}
    for i in range(400_000):
        text = " ".join(f"{i}x{j}" for j in range(40))
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text:
            return other, text
    raise AssertionError("no two texts collide")


@pytest.mark.parametrize("doc_id", [None, 7])
def test_unlike_texts_of_one_id_and_crc_stay_apart(spark, colliding, doc_id):
    a, b = colliding
    rows = [(doc_id, a, "en", "s", 1), (doc_id, b, "en", "s", 1), (None, a + " and more of it", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r["text"] for r in substrings.remove_repeats(docs).collect()}
    assert kept == {"", b, "and more of it"}
    assert b in {r["text"] for r in jaccard.keep_one(docs).collect()} and jaccard.keep_one(docs).count() == 2
    bench = spark.createDataFrame([(1, a)], "item_id long, text string")
    assert [r["text"] for r in decontaminate.drop_contaminated(docs, bench).collect()] == [b]


def test_mixture_takes_columns_of_any_name(spark):
    names = ["target", "source_no", "source_size", "finish", "copies", "size", "_size", "_key", "_range", "_cum", "_source", "_doc", "_mark", "w", "k"]
    rows = [(i, "a b c d" if i % 2 else "e f", None, f"s{i % 3}", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plain = sorted((r["doc_id"], r["copy"]) for r in mixing.mixture(docs).collect())
    more = mixing.mixture(docs.select("*", *[F.lit(f"my {n}").alias(n) for n in names], F.lit(99).alias("copy")))
    assert more.columns == [*docs.columns, *names, "copy"] and plain
    got = more.collect()
    assert sorted((r["doc_id"], r["copy"]) for r in got) == plain and all(r[n] == f"my {n}" for r in got for n in names)


def test_the_mix_of_equal_ids_and_sizes_does_not_depend_on_the_order(spark):
    rows = [(None if i % 2 else 5, f"w{i} x y", None, "s", 1) for i in range(40)] + [(1, "z " * 200, None, "t", 1)]
    taken = [sorted((r["text"], r["copy"]) for r in mixing.mixture(spark.createDataFrame(rows[::step], SCHEMA).repartition(n)).collect())
             for step, n in ((1, 1), (-1, 5))]
    assert taken[0] == taken[1]


def test_double_vectors_are_compared_in_double(spark):
    near, off = [1.0, 0.0], [0.95, (1 - 0.95 ** 2) ** 0.5 + 1e-9]
    rows = [(1, [1e39, 0.0]), (2, [1e39, 1.0]), (3, [0.0, 1e-60]), (4, near), (5, off), (6, [1e308, 1e308])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_join.near_duplicates(
        spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
    got = {r["vec_id"]: r["n_links"] for r in embed_join.near_duplicates(spark.createDataFrame(rows[3:5], "vec_id long, embedding array<double>")).collect()}
    assert got == {4: 0, 5: 0}
