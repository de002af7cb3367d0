"""Katz backoff models of any order from stored n-gram tables.

`counts(texts, order)` writes one partitioned table an order: the distinct n-grams of
all texts with their number of occurrences in the training texts, the lower
orders summed from the higher. `probabilities` evaluates the model recursively:

    P(w|h) = d(c) c / c(h)           if the n-gram was seen in training
           = alpha(h) P(w|h')        else, h' being h without its first word
    alpha(h) = (1 - sum of P(w|h) over seen w) / (1 - sum of P(w|h') over seen w)

with Good-Turing factors d, so every context sums to 1; a context that was never
seen has alpha 1, and the word level gives its rest to the class of unknown
words. `score` looks the n-grams of every text up in the table of the highest
order.

Everything is an aggregate or a join on whole keys: tasks aggregate the n-grams of
their own texts before anything is exchanged, no n-gram or context is gathered in
one group, and a context's terms are one row. Frequent words and copies make no
task larger than what adaptive execution splits. The driver sees counts of counts only.

Defined results are those of `katz`: words are runs of bytes other than white
space, A-Z folded; null and empty texts are one end token; without training
rows every word is unknown and the score is 0; equal rows get equal scores; other
columns are ignored. Words are told apart by 64-bit hashes, rows by 64-bit
hashes of id and text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import written
from staylens.llm.katz import END, K, START, Words, _tokens, discounts, word_level

HELD = 1_000_000


def _words(order: int) -> list[str]:
    """Columns of an n-gram, the token last: w3, w2, w1 for order 3."""
    return [f"w{k}" for k in range(order, 0, -1)]


def _grams(texts: DataFrame, order: int, by_text: bool) -> DataFrame:
    """The distinct n-grams of each task's texts (``by_text``: of each text, by
    ``key``) with their occurrences ``n`` and those in training ``c``."""
    names = _words(order)

    def emit(batches):
        import pyarrow as pa
        held, size = [], 0

        def flush():
            cols = [np.concatenate(x) for x in zip(*held)]
            parts = order + 1 if by_text else order
            at = np.lexsort(tuple(cols[:parts]))
            cols = [x[at] for x in cols]
            new = np.zeros(len(at), bool)
            new[0] = True
            for x in cols[:parts]:
                new[1:] |= x[1:] != x[:-1]
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(new)))
            c = np.add.reduceat(cols[order + 1].astype(np.int64), first)
            out = [pa.array(x[first].view(np.int64)) for x in cols[:order]]
            out += [pa.array(cols[order][first])] if by_text else []
            whole = pa.table([*out, pa.array(n if by_text else c)], names=[*names, *(["key", "n"] if by_text else ["c"])])
            yield from whole.to_batches(max_chunksize=50_000)

        for b in batches:
            keys, train = b.column("key").to_numpy(), b.column("train").to_numpy(zero_copy_only=False)
            for lo, words, rows in _tokens(b.column("text")):
                start = np.cumsum(rows) - rows
                cols, last = [words], words
                for k in range(1, order):
                    before = np.empty_like(last)
                    before[1:] = last[:-1]
                    before[start] = START
                    cols.append(before)
                    last = before
                at = np.repeat(np.arange(lo, lo + len(rows)), rows)
                held.append([*cols[::-1], keys[at], train[at]])
                size += len(words)
                if size >= HELD:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    kind = ", ".join(f"{x} long" for x in names)
    return texts.mapInArrow(emit, kind + (", key long, n long" if by_text else ", c long"))


def counts(texts: DataFrame, order: int) -> dict[int, DataFrame]:
    """Written tables by order: (words, c) of the distinct n-grams of ``texts``
    (key, train, text), c being their number in the rows that train."""
    tables, here = {}, _grams(texts, order, by_text=False)
    for k in range(order, 0, -1):
        here = written(here.groupBy(*_words(k)).agg(F.sum("c").alias("c")), f"grams-{k}")
        tables[k] = here
    return tables


def _factor(d: np.ndarray) -> Column:
    """The Good-Turing factor of the column c."""
    out = F.lit(1.0)
    for r in range(1, K + 1):
        out = F.when(F.col("c") == r, F.lit(float(d[r]))).otherwise(out)
    return out


def probabilities(tables: dict[int, DataFrame], level: Words, order: int) -> DataFrame:
    """(words, p) of every n-gram of the table of ``order``, by recursion over
    the orders below."""
    own = tables[order]
    if order == 1:
        if not level.n:
            return own.select("w1", F.lit(1.0).alias("p"))
        seen = F.lit(float(level.scale)) * _factor(level.d) * F.col("c") / level.n
        return own.select("w1", F.when(F.col("c") > 0, seen).otherwise(F.lit(float(level.unknown))).alias("p"))
    names, lower = _words(order), _words(order - 1)
    context = names[:-1]
    of = {r["c"]: r["n"] for r in own.filter(F.col("c").between(1, K + 1)).groupBy("c").agg(F.count("*").alias("n")).collect()}
    d = discounts(of)
    below = probabilities(tables, level, order - 1).withColumnRenamed("p", "p_low")
    both = written(own.join(below, lower), f"grams-{order}-low")
    terms = (both.filter(F.col("c") > 0).groupBy(*context)
             .agg(F.sum("c").alias("tokens"), F.sum(_factor(d) * F.col("c")).alias("kept"), F.sum("p_low").alias("low")))
    seen = F.col("kept") / F.col("tokens")
    # a context without rare n-grams leaves nothing: it gives up one count
    left = F.when(1 - seen > 1e-9, 1 - seen).otherwise(1 / (F.col("tokens") + 1))
    terms = terms.select(*context, "tokens", ((1 - left) / F.greatest(seen, F.lit(1e-300))).alias("scale"),
                         (left / F.greatest(1 - F.col("low"), F.lit(1e-300))).alias("alpha"))
    p = (F.when(F.col("c") > 0, F.col("scale") * _factor(d) * F.col("c") / F.col("tokens"))
         .otherwise(F.coalesce("alpha", F.lit(1.0)) * F.col("p_low")))
    return written(both.join(terms, context, "left").select(*names, p.alias("p")), f"grams-{order}-p")


def score(docs: DataFrame, train: Column, order: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text of ``docs`` with the model of the rows for which
    ``train`` holds: (id, train, n_tokens, n_known, train_tokens, base_score,
    score), logarithms to base 10."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own_id = F.col(f"`{id_col}`")
    texts = docs.select(own_id.alias("id"), F.xxhash64(own_id.cast("string"), own_id.isNull(), text).alias("key"),
                        F.coalesce(train, F.lit(False)).alias("train"), text.alias("text"))
    tables = counts(texts, order)
    level = word_level(tables[1].filter(F.col("c") > 0))
    base = F.log10((F.col("c") + 1) / F.lit(float(level.n + level.v + 1)))
    of_gram = probabilities(tables, level, order)
    names = _words(order)
    of_gram = of_gram.join(tables[1].select("w1", (F.col("c") > 0).alias("known"), base.alias("base")), "w1")
    of_gram = of_gram.select(F.xxhash64(*names).alias("gram"), F.log10("p").alias("lp"), "known", "base",
                             (F.col("w1") == int(END.astype(np.int64))).alias("end"))
    asked = _grams(texts, order, by_text=True).select("key", F.xxhash64(*names).alias("gram"), F.col("n").cast("int").alias("n"))
    n = F.col("n")
    scored = (asked.join(of_gram, "gram").groupBy("key")
              .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("known"), n).otherwise(0)).alias("n_known"), F.sum(n * F.col("base")).alias("base"),
                   F.sum(n * F.col("lp")).alias("s"), F.sum(F.when(F.col("end"), n).otherwise(0)).alias("copies")))
    # equal rows were scored together: each takes its share
    share = lambda x: F.col(x) / F.col("copies")
    return texts.select("id", "key", "train").join(scored, "key").select(
        "id", "train", share("n").cast("long").alias("n_tokens"), share("n_known").cast("long").alias("n_known"),
        F.lit(level.n).cast("long").alias("train_tokens"), share("base").alias("base_score"), share("s").alias("score"))
