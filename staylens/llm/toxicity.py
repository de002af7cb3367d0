"""Toxicity scores from class-conditional Kneser-Ney models.

Two word models, toxic and ordinary, share their backoff. A class's word
probability is the discounted count of the distinct words it follows in the
class, backed off to the discounted count of its stem (first bytes) and from
there to the stem's count in both classes together, so a rare expression gets
the evidence of its stem and else none. Word pairs seen in more than ``D_PAIR`` texts
of a class refine it with the context, with a backoff weight per context that
both classes share. All counts are over distinct texts, so
copies and repetition inside one text carry no weight of their own.

A text is judged by the difference of its two log-likelihoods, normalised by
length: over the whole text, over its most toxic stretch of ``STRETCH`` words
and over its most toxic expressions. A logistic curve fitted on labelled texts
that the counts did not use turns the three into a probability.

The classifier learns from a bounded sample (at most about ``per_class``
toxic and ``ordinary_factor * per_class`` ordinary labelled texts, by id hash);
every text is scored whole.

Defined results: null and empty texts get the score of a text without evidence;
no label of one class makes every score 0; equal texts get equal scores; other
columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

D_WORD, D_STEM, D_PAIR = 2.0, 2.0, 3.0
STEM_BYTES, STRETCH, TOP = 6, 25, 3


def _empty():
    return np.zeros(0, np.uint64), np.zeros(0, np.float32)


@dataclass
class ToxicityModel:
    """Sorted hash tables of log-likelihood differences and the curve."""

    words: tuple = field(default_factory=_empty)
    stems: tuple = field(default_factory=_empty)
    pairs: tuple = field(default_factory=_empty)
    unseen: float = 0.0
    curve: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None

    def differences(self, word: np.ndarray, stem: np.ndarray, pair: np.ndarray) -> np.ndarray:
        out = np.full(len(word), self.unseen, np.float32)
        for (keys, values), asked in ((self.stems, stem), (self.words, word), (self.pairs, pair)):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                hit = keys[at] == asked
                out[hit] = values[at[hit]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(x))
        z = ((x - self.mean) / self.scale) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _hashed(column):
    """For each piece of an Arrow text column: (first row, last row, word
    hashes, stem hashes, context hashes, pair hashes, words per row)."""
    from staylens.llm.words import ALNUM, mix, pieces, text_buffer, word_bounds, word_hashes
    for lo, hi, data, off in pieces(*text_buffer(column)):
        s, e, counts = word_bounds(data, off, ALNUM)
        word = word_hashes(data, s, e, lower=True)
        stem = word_hashes(data, s, np.minimum(e, s + STEM_BYTES), lower=True)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        first = np.cumsum(counts) - counts
        before[first[counts > 0]] = 0
        yield lo, hi, word, stem, before, mix(before * np.uint64(0x9E3779B97F4A7C15) ^ word), counts


def _evidence(d: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per row: mean difference over the text, over the best stretch, and over
    the strongest expressions."""
    out = np.zeros((len(counts), 3))
    end = np.cumsum(counts)
    for i, n in enumerate(counts):
        if n:
            v = d[end[i] - n:end[i]].astype(np.float64)
            c = np.concatenate([[0.0], np.cumsum(v)])
            k = min(STRETCH, n)
            top = np.partition(v, n - TOP)[-TOP:] if n > TOP else v
            out[i] = v.mean(), ((c[k:] - c[:-k]) / k).max(), top.sum() / TOP
    return out


def _sample(docs: DataFrame, labels: DataFrame, per_class: int, ordinary_factor: int) -> tuple[DataFrame, dict]:
    """Distinct labelled texts (toxic, text) and the share taken of each class."""
    per_id = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in per_id.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, bound / max(1, n.get(k, 0))) for k, bound in ((1, per_class), (0, ordinary_factor * per_class))}
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("toxic:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("double") / (1 << 32)
    ids = per_id.filter(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    sampled = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter(F.col("text").isNotNull())
    return sampled.groupBy("text").agg(F.max("toxic").alias("toxic")), share


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000, ordinary_factor: int = 3) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) over ``docs`` (doc_id, text)."""
    sample, share = _sample(docs, labels, per_class, ordinary_factor)
    part = F.pmod(F.xxhash64("text"), F.lit(10))
    sample = sample.withColumn("fit", part < 6)

    def count(batches):
        import pyarrow as pa
        for b in batches:
            toxic = np.array(b.column("toxic").to_pylist(), np.int64)
            for lo, hi, word, stem, before, pair, counts in _hashed(b.column("text")):
                doc = np.repeat(np.arange(hi - lo), counts)
                _, once = np.unique(pair * np.uint64(3) ^ (doc.astype(np.uint64) << np.uint64(40)), return_index=True)
                t = toxic[lo:hi][doc[once]]
                cols = [x[once].view(np.int64) for x in (pair, before, word, stem)] + [t, 1 - t]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["pair", "context", "word", "stem", "t", "o"])

    pairs = (sample.filter("fit").select("text", "toxic")
             .mapInArrow(count, "pair long, context long, word long, stem long, t long, o long")
             .groupBy("pair", "context", "word", "stem").agg(F.sum("t").alias("t"), F.sum("o").alias("o")))
    words = pairs.groupBy("word", "stem").agg(
        F.sum((F.col("t") > 0).cast("long")).alias("t"), F.sum((F.col("o") > 0).cast("long")).alias("o")).toPandas()
    if not len(words) or not words.t.sum() or not words.o.sum():
        return ToxicityModel()
    model, p_word = _probabilities(words)
    contexts = pairs.groupBy("context").agg(F.sum("t").alias("ct"), F.sum("o").alias("co"), F.count("*").alias("types"))
    frequent = pairs.filter((F.col("t") > D_PAIR) | (F.col("o") > D_PAIR)).select("pair", "context", "word", "t", "o")
    model.pairs = _pair_table(frequent.join(contexts, "context").toPandas(), words.word, p_word)
    _fit_curve(model, sample.filter("not fit").select("text", "toxic"), share)
    return model


def _table(keys, values) -> tuple:
    keys = np.asarray(keys, np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.asarray(values, np.float32)[order]


def _probabilities(words):
    """The model of words and stems from continuation counts (columns t, o), and
    each word's probability in both classes."""
    c = words[["t", "o"]].to_numpy(float)
    n = c.sum(axis=0)
    stems = words.groupby("stem")[["t", "o"]].sum()
    s = stems.to_numpy(float)
    shared = np.minimum(s.sum(axis=1), 2 * D_STEM) / s.sum()
    left = np.minimum(s, D_STEM).sum(axis=0) / n
    p_stem = np.maximum(s - D_STEM, 0) / n + left * shared[:, None]
    back = np.minimum(c, D_WORD).sum(axis=0) / n
    at = stems.index.get_indexer(words.stem)
    inside = np.minimum(c.sum(axis=1), 2 * D_WORD) / np.maximum(s[at].sum(axis=1), 1)
    p_word = np.maximum(c - D_WORD, 0) / n + back * p_stem[at] * inside[:, None]
    ratio = lambda p: np.log(p[:, 0] / p[:, 1])
    model = ToxicityModel(words=_table(words.word, ratio(p_word)),
                          stems=_table(stems.index.to_numpy(), ratio(p_stem * back)),
                          unseen=float(np.log(left[0] * back[0] / (left[1] * back[1]))))
    return model, p_word


def _pair_table(pairs, words, p_word) -> tuple:
    """Differences of the frequent word pairs: the discounted share of the pair
    in its context, backed off to the word with the context's shared weight."""
    if not len(pairs):
        return _empty()
    import pandas as pd
    p = p_word[pd.Index(words).get_indexer(pairs.word)]
    c = pairs[["t", "o"]].to_numpy(float)
    of = pairs[["ct", "co"]].to_numpy(float)
    back = np.minimum(1.0, D_PAIR * pairs.types.to_numpy(float) / of.sum(axis=1))
    p = np.maximum(c - D_PAIR, 0) / np.maximum(of, 1) + back[:, None] * p
    return _table(pairs.pair, np.log(p[:, 0] / p[:, 1]))


def _fit_curve(model: ToxicityModel, rest: DataFrame, share: dict) -> None:
    """Logistic regression on the texts that the counts did not use; each class
    counts as often as it occurs before sampling."""

    def measure(batches):
        import pyarrow as pa
        for b in batches:
            for lo, hi, word, stem, before, pair, counts in _hashed(b.column("text")):
                x = _evidence(model.differences(word, stem, pair), counts)
                yield pa.RecordBatch.from_arrays(
                    [b.column("toxic").slice(lo, hi - lo), *[pa.array(x[:, j]) for j in range(3)]], ["toxic", "a", "b", "c"])

    got = rest.mapInArrow(measure, "toxic int, a double, b double, c double").toPandas()
    got = got.sort_values(["toxic", "a", "b", "c"])
    y = got.toxic.to_numpy(float)
    if not len(y) or y.min() == y.max():
        return
    x = got[["a", "b", "c"]].to_numpy()
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - model.mean) / model.scale, np.ones(len(y))])
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    w = np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        h = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag([1.0, 1.0, 1.0, 1e-6])
        g = z.T @ (weight * (y - p)) - np.array([1.0, 1.0, 1.0, 0]) * w
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    model.curve = w


def scorer(model: ToxicityModel):
    """Arrow UDF text -> probability of being toxic."""

    @F.arrow_udf("double")
    def score(text):
        import pyarrow as pa
        out = np.zeros(len(text))
        for lo, hi, word, stem, before, pair, counts in _hashed(text):
            out[lo:hi] = model.score(_evidence(model.differences(word, stem, pair), counts))
        return pa.array(out)

    return score
