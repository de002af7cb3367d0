"""Filter interaction audit by contingency tensor contractions.

Every document passes or fails each of five filters, so a part of the corpus is
a 2x2x2x2x2 tensor of counts, one axis a filter (0 passes, 1 fails). Whatever an
order of the filters keeps or removes at a step is that tensor contracted with
one vector an axis: (1, 0) selects what passes, (0, 1) what fails, (1, 1) all.
Documents are read once, for all 120 orders; from then on there are at most 32
rows a part.

The filters, on whole texts (null counts as empty); failing means

    A  under 200 words ``[^\\x20\\x09-\\x0D]+``
    B  100 * distinct words < 50 * words
    C  100 * ``[A-Z]`` characters > 2 * code points
    D  any of ``#$%&*|``
    E  equal to the text of any smaller id, removed or not

Defined results: a null id is neither smaller nor larger than another, so it
never fails E and makes no other row fail it; rows of one id and text are not
smaller than each other; a null source is the part of the empty string; several
label rows of a document count as their largest values, label rows without an
id or document count for nothing; an empty table has no parts. Only the columns
named are read, so further ones may have any name.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.common import written
from staylens.llm.words import pieces, text_buffer, word_bounds, word_hashes

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 2
MARKS = b"#$%&*|"

PASSES, FAILS, ALL = (1, 0), (0, 1), (1, 1)


def _bit(letter: str, filters: str = FILTERS) -> int:
    """The first filter is the tensor's first axis, so the highest bit."""
    return 1 << (len(filters) - 1 - filters.index(letter))


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return upto[off[1:]] - upto[off[:-1]]


def text_failures(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each row of UTF-8 bytes fails. Distinct
    words are told apart by 64-bit hashes."""
    starts, ends, n = word_bounds(data, off)
    row = np.repeat(np.arange(len(n)), n)
    hashes = word_hashes(data, starts, ends)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    distinct = np.bincount(row[new], minlength=len(n))
    capitals = _per_row((data >= ord("A")) & (data <= ord("Z")), off)
    points = _per_row((data & 0xC0) != 0x80, off)
    marks = _per_row(np.isin(data, np.frombuffer(MARKS, np.uint8)), off)
    return ((n < MIN_WORDS) * _bit("A") + (100 * distinct < MIN_DISTINCT * n) * _bit("B")
            + (100 * capitals > MAX_CAPITALS * points) * _bit("C") + (marks > 0) * _bit("D")).astype(np.int32)


@F.arrow_udf(T.IntegerType())
def _text_failures(text):
    found = [text_failures(d, o) for _, _, d, o in pieces(*text_buffer(text))]
    return pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32())


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed) of every row of ``docs`` (doc_id, text, source):
    ``failed`` holds the bits of all filters that it fails.

    The texts are read once; what meets by text are 32-byte digests. Only
    digests that occur more than once have a row on the join's other side,
    which is a written table, so that a text with a third of all copies is
    split like any skewed join."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = written(docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                               _text_failures("text").alias("own"), F.unhex(F.sha2(text, 256)).alias("digest")), "audit-rows")
    least = written(slim.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
                    .filter("n > 1").select("digest", "least"), "audit-copies")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return slim.join(least, "digest", "left").select(
        "doc_id", "part", (F.col("own") + F.when(copy, _bit("E")).otherwise(0)).alias("failed"))


def counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): the cells of every part's tensor that
    hold documents, at most 32 a part, counted map-side first."""
    marked = written(labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")), "audit-labels")
    return failed.join(marked, "doc_id", "left").groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


class Steps:
    """Selectors of all steps of all orders of the filters: one (steps, filters,
    2) array a question."""

    def __init__(self, filters: str = FILTERS):
        n = len(filters)
        self.filters = filters
        self.orders = ["".join(p) for p in permutations(filters)]
        self.order = np.repeat(self.orders, n)
        self.step = np.tile(np.arange(1, n + 1), len(self.orders))
        self.own = np.array([filters.index(x) for o in self.orders for x in o])
        place = np.array([[o.index(x) + 1 for x in filters] for o in self.orders])[np.repeat(np.arange(len(self.orders)), n)]
        at = self.step[:, None]
        self.kept = self._select([(place <= at, PASSES)])
        self.removed = self._select([(place < at, PASSES), (place == at, FAILS)])
        self.failing = self._select([(place == at, FAILS)])
        self.alone = self._select([(place != at, PASSES), (place == at, FAILS)])

    def _select(self, rules) -> np.ndarray:
        out = np.ones((len(self.step), len(self.filters), 2), np.int64)
        for where, vector in rules:
            out[where] = vector
        return out

    def contract(self, tensor: np.ndarray, selectors: np.ndarray) -> np.ndarray:
        """Sums of ``tensor`` (measures, 2, 2, ...) that each step selects: (measures, steps)."""
        axes = "abcdefgh"[:len(self.filters)]
        return np.einsum(f"m{axes},{','.join('s' + x for x in axes)}->ms", tensor, *[selectors[:, i] for i in range(len(axes))])


SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def interactions(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the tensor cells
    ``cells`` (part, failed, n, good, toxic): documents kept after the step,
    removed by it, redundant (they fail it but are gone already), failing only
    this filter, good and toxic ones removed, and the filter's removals summed
    over all orders."""

    def contract(table: pa.Table) -> pa.Table:
        steps = Steps(filters)
        flat = np.zeros((3, 1 << len(filters)), np.int64)
        for i, name in enumerate(("n", "good", "toxic")):
            np.add.at(flat[i], table["failed"].to_numpy(), table[name].to_numpy())
        tensor = flat.reshape(3, *[2] * len(filters))
        removed = steps.contract(tensor, steps.removed)
        n = tensor[:1]
        shapley = np.zeros(len(filters), np.int64)
        np.add.at(shapley, steps.own, removed[0])
        out = {"part": [table["part"][0].as_py()] * len(steps.step), "filter_order": steps.order.tolist(), "step": pa.array(steps.step, pa.int32()),
               "kept": steps.contract(n, steps.kept)[0], "removed": removed[0],
               "redundant": steps.contract(n, steps.failing)[0] - removed[0], "unique_fails": steps.contract(n, steps.alone)[0],
               "good_lost": removed[1], "toxic_lost": removed[2], "shapley": shapley[steps.own]}
        return pa.table(out)

    return cells.groupBy("part").applyInArrow(contract, SCHEMA)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``docs`` (doc_id, text, source) with
    ``labels`` (doc_id, quality, toxic)."""
    return interactions(counts(failures(docs), labels))
