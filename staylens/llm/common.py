"""Helpers shared by the operators: written intermediate tables, stable
document fields, and connected components."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import ensure_checkpoint_dir


#: For a table of large rows: a writer that looks at its buffers after every
#: hundred rows only would make one row group of all rows of a task, which it
#: holds as a whole, and a reader decodes row groups as a whole.
LARGE_ROWS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


def written(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the session's shared checkpoint folder and
    return a reader of it, so that later steps (and retries after the loss of
    an executor) start from the table and not from the raw input."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col, n: int):
    """crc32 of the id's text modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def text_mark(text):
    """16 bytes (md5) that tell a text from others, null counting as empty: rows
    are told apart by their id and this mark, so unlike texts under one id, or
    without an id, stay apart and equal ones count as one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b long).

    Alternates the two star steps: every node hangs its larger neighbours on
    its least neighbour, then every node hangs its smaller neighbours on the
    least of them. Both are aggregates and joins on the node, never lists, so
    a hub with many neighbours is no special case. Each round is a written
    table. Returns (node, component) with component the least node reachable;
    nodes without an edge to another node are absent.
    """
    cur = written(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges")
    seen = None
    for _ in range(max_rounds):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        cur = written(small.filter(F.col("u") != F.col("v")).distinct(), "stars")
        state = cur.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))


def forest(m: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Edges (node, least node) that connect what the link matrix ``m`` between
    the nodes ``left`` and ``right`` connects; at most one edge a node."""
    rows, cols = np.flatnonzero(m.any(axis=1)), np.flatnonzero(m.any(axis=0))
    if not len(rows):
        return
    m, a, b = m[np.ix_(rows, cols)], left[rows].copy(), right[cols].copy()
    top = np.iinfo(np.int64).max
    while True:
        a2 = np.minimum(a, np.where(m, b[None, :], top).min(axis=1))
        b2 = np.minimum(b, np.where(m, a2[:, None], top).min(axis=0))
        if (a2 == a).all() and (b2 == b).all():
            break
        a, b = a2, b2
    yield from ((int(u), int(v)) for u, v in zip(left[rows], a) if u != v)
    yield from ((int(u), int(v)) for u, v in zip(right[cols], b) if u != v)
