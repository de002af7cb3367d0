"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents wait in a shuffled order. A copy of a
document gets the virtual finish time

    (words of its source up to and including the copy) / target of the source

All copies are served in order of that time until the total budget is spent.
At time 1 each source has been served its target, so the mix keeps the target
shares and no source is starved by a large one.

Both running sums (words within a source, words over all copies) are built
from sums over ranges of the sort key plus an order inside one range, so a
source with a third of all rows is spread over many tasks.

Defined results: a null or empty text has 0 words and is never taken; a null
source is a source of its own, the last; a null id shuffles like an empty one;
equal rows each wait for themselves; an empty table gives an empty result.
Other columns of the input pass through untouched, whatever their names in
`mixture`; `mix` takes the place of columns with the names that it adds
(`source_no`, `source_size`, `target`, `finish`, `copies`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.llm.common import text_mark

WEIGHTS = (3, 1, 2)


@F.arrow_udf(T.LongType())
def word_count(text):
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of each text (null: 0)."""
    import numpy as np
    import pyarrow as pa

    from staylens.llm.words import pieces, text_buffer, word_bounds
    counts = [word_bounds(d, o)[2] for _, _, d, o in pieces(*text_buffer(text))]
    return pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, repeats: int = 2) -> DataFrame:
    """Targets of the sources of ``sizes`` (source, size): (source, source_no,
    source_size, target).

    Sources in code-point order, null last, get ``weights`` in turn and share
    ``share`` times all words by weight. No target exceeds ``repeats`` times
    its source; the excess is shared again by weight. With sources ordered by
    limit per weight, the limited ones are a prefix, found with one running
    sum. One row per source is ordered here, nothing larger.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("source_no", F.row_number().over(by_name))
           .withColumn("w", w.cast("long"))
           .withColumn("cap", (F.col("source_size") * repeats).cast("long")))
    every = W.partitionBy()
    order = W.orderBy(F.col("cap") / F.col("w"), "source_no")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    per = (per.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
           .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("limited", F.col("cap") <= (F.col("budget") - F.col("cap_before")) / F.col("w_left") * F.col("w")))
    free = ~F.col("limited")
    per = per.withColumn(
        "rate", (F.first("budget").over(every) - F.coalesce(F.sum(F.when(F.col("limited"), F.col("cap"))).over(every), F.lit(0)))
        / F.sum(F.when(free, F.col("w"))).over(every))
    return per.select("source", "source_no", "source_size",
                      F.when(F.col("limited"), F.col("cap").cast("double")).otherwise(F.col("rate") * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size",
        weights=WEIGHTS, share: float = 1.5, repeats: int = 2, range_rows: int = 8192, tie_col: str | None = None) -> DataFrame:
    """Serve ``docs`` by weighted fair queueing and add `source_size`, `target`,
    `finish` (virtual finish time of the first copy) and `copies` (0 to
    ``repeats``: how many copies the mix takes).

    ``docs`` carries its word count in ``size_col``. A later copy of a document
    waits a whole pass of its source behind the earlier one. The mix is the
    longest prefix of all copies, ordered by finish time, whose words fit the
    budget. ``range_rows`` is the mean number of rows ordered together;
    ``tie_col`` orders rows of one id and size. Columns of ``docs`` with the
    names of added ones are replaced.
    """
    docs = docs.drop(*[c for c in ("source_size", "source_no", "target", "finish", "copies") if c not in (id_col, source_col, size_col)])
    sizes = docs.select(F.col(source_col).alias("source"), F.col(size_col).alias("size"))
    targets = source_targets(sizes, weights, share, repeats)
    n_rows, words = docs.agg(F.count("*"), F.coalesce(F.sum(size_col), F.lit(0))).first()
    n_ranges = max(1, -(-n_rows // range_rows))
    budget = int(words * share)

    shuffle_key = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    keyed = (docs.withColumnRenamed(source_col, "_source").join(
        targets.withColumnRenamed("source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
        .withColumn("_key", shuffle_key)
        .withColumn("_range", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * n_ranges / F.lit(1 << 32))))
    sums = keyed.groupBy("source_no", "_range").agg(F.sum(size_col).alias("_n"))
    earlier = W.partitionBy("source_no").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("source_no", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy("source_no", "_range").orderBy("_key", size_col, *[tie_col] * (tie_col is not None)).rowsBetween(W.unboundedPreceding, 0)
    queued = (keyed.join(sums, ["source_no", "_range"])
              .withColumn("_cum", F.col("_before") + F.sum(size_col).over(inside)).drop("_before"))

    def entry(k: int) -> Column:
        """What copy ``k`` is served by: finish time, then fixed tie-breaks."""
        return F.struct(((F.col("source_size") * k + F.col("_cum")) / F.col("target")).alias("t"),
                        F.col("source_no").alias("s"), F.lit(k).alias("k"), F.col("_key").alias("d"),
                        F.col(size_col).alias("n"))

    last = _last_served(queued.filter(F.col(size_col) > 0).select(
        F.explode(F.array(*[entry(k) for k in range(repeats)])).alias("e")), budget, n_ranges)
    if last is None:
        copies = F.lit(0)
    else:
        cut = F.struct(F.lit(last["t"]).alias("t"), F.lit(last["s"]).alias("s"), F.lit(last["k"]).alias("k"),
                       F.lit(last["d"]).alias("d"), F.lit(last["n"]).alias("n"))
        copies = sum((F.when(entry(k) <= cut, 1).otherwise(0) for k in range(repeats)), F.lit(0))
        copies = F.when(F.col(size_col) > 0, copies).otherwise(0)
    return (queued.withColumn("copies", copies)
            .withColumn("finish", F.when(F.col(size_col) > 0, entry(0)["t"]))
            .withColumnRenamed("_source", source_col).drop("_key", "_range", "_cum", "source_no"))


def _last_served(entries: DataFrame, budget: int, n_ranges: int):
    """The last entry of the longest prefix whose words fit ``budget``.

    Entries fall into ranges of finish time; the running sum over ranges finds
    the one in which the budget runs out, and only that one is ordered.
    """
    slot = F.least(F.floor(F.col("e.t") * n_ranges), F.lit(4 * n_ranges)).cast("long")
    entries = entries.withColumn("slot", slot)
    upto = W.orderBy("slot").rowsBetween(W.unboundedPreceding, 0)
    slots = (entries.groupBy("slot").agg(F.sum("e.n").alias("n"))
             .withColumn("upto", F.sum("n").over(upto)))
    over = slots.filter(F.col("upto") > budget).orderBy("slot").first()
    if over is None:
        top = entries.agg(F.max("e").alias("e")).first()
        return top["e"] if top else None
    before = over["upto"] - over["n"]
    cum = F.sum("e.n").over(W.orderBy("e").rowsBetween(W.unboundedPreceding, 0))
    served = (entries.filter(F.col("slot") == over["slot"]).withColumn("cum", cum + F.lit(before))
              .filter(F.col("cum") <= budget).agg(F.max("e").alias("e")).first()["e"])
    if served is not None:
        return served
    return entries.filter(F.col("slot") < over["slot"]).agg(F.max("e").alias("e")).first()["e"]


def mixture(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mixed corpus: one row per taken copy of a document, the columns of
    ``docs`` plus `copy` (from 1; a column of that name in ``docs`` goes).
    Documents of which nothing is taken go. Of rows with one id and size the
    text's `text_mark` decides which waits first."""
    # columns of any name ride along in one struct
    packed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
                         text_mark(F.col(f"`{text_col}`")).alias("_mark"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    mixed = mix(packed, tie_col="_mark", **options).filter(F.col("copies") > 0)
    return mixed.select(*[F.col(f"_doc.`{c}`") for c in docs.columns if c != "copy"],
                        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
