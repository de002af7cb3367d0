"""Language identification by averaged hashed subword embeddings.

Every byte n-gram of the folded text (ASCII lower case, digits alike, white
space as the word boundary) is hashed to a row of an embedding table; a text is
the mean of its rows, and a linear softmax maps the mean to languages. The
tables are learned by stochastic gradient descent in numpy on a bounded sample
of labelled texts (``per_lang`` texts a language, taken by a hash of the id),
each seen whole and as one short random snippet, so short texts are judged with
honest uncertainty. A temperature fitted on texts kept out of the training
calibrates the probabilities; texts under the calibrated limit can be rejected.

Defined results: null text or text without a letter is `und` with score 0; an
empty set of labelled texts makes every text `und`; equal texts get equal
results; texts of any length are read whole; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
GRAMS = (1, 2, 3, 4)
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    """Languages, embedding rows, softmax weights and calibration."""

    langs: list[str] = field(default_factory=list)
    embed: np.ndarray | None = None
    out: np.ndarray | None = None
    bias: np.ndarray | None = None
    temperature: float = 1.0
    limit: float = 0.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = ((x @ self.embed) @ self.out + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _fold() -> np.ndarray:
    from staylens.llm.words import LOWER
    t = LOWER.copy()
    t[0x30:0x3A] = 0x30
    t[[0x20, *range(0x09, 0x0E)]] = 0x20
    return t


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mean bucket counts (rows x BUCKETS, float32) of the rows' byte n-grams."""
    rows = len(off) - 1
    x = _fold()[data].astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(off))
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(data))
    total = np.zeros(rows * BUCKETS, np.float32)
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        m = len(data) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint32(257) + x[n - 1:] + np.uint32(1)
        if n in GRAMS:
            bucket = (code * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64)
            ok = left[:m] >= n
            total += np.bincount(row[:m][ok] * BUCKETS + bucket[ok], minlength=rows * BUCKETS)
    total = total.reshape(rows, BUCKETS)
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1)


def _blocks(text, rows: int = 64):
    """(first row, last row, features) of an Arrow text column, few rows at a time."""
    from staylens.llm.words import pieces, text_buffer
    data, off = text_buffer(text)
    for lo, hi, d, o in pieces(data, off, 1 << 20):
        for a in range(0, hi - lo, rows):
            b = min(a + rows, hi - lo)
            yield lo + a, lo + b, features(d[o[a]:o[b]], o[a:b + 1] - o[a])


def _sampled(labelled: DataFrame, per_lang: int, most: int) -> DataFrame:
    """About ``per_lang`` unlike (lang, text) rows of every language, by a hash of
    the text, so that copies and rows that share an id, or have none, add
    nothing; about ``most`` rows of all languages together."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return labelled.select("lang", "text").limit(0)
    each = min(per_lang, most / len(counts))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, float(min(1.0, each / n)))])
    mark = F.md5(F.concat(F.lit("lang:"), F.col("text")))
    draw = F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") / float(1 << 32)
    drawn = labelled.filter(draw < share[F.col("lang")]).select("lang", "text", mark.alias("_mark"))
    return drawn.dropDuplicates(["lang", "_mark"]).select("lang", "text")


def _snippet(data: np.ndarray, rng: np.random.Generator, words: int = 8) -> np.ndarray:
    """A random run of a few words."""
    from staylens.llm.words import word_bounds
    s, e, _ = word_bounds(data, np.array([0, len(data)]))
    if len(s) <= words:
        return data
    i = int(rng.integers(0, len(s) - words))
    return data[s[i]:e[i + words - 1]]


def train(labelled: DataFrame, per_lang: int = 400, dim: int = 16, epochs: int = 40, rate: float = 0.5,
          reject_share: float = 0.001, seed: int = 7, most: int = 8000) -> LanguageModel:
    """Learn a `LanguageModel` from ``labelled`` (id, lang, text). At most about
    ``per_lang`` unlike texts a language and ``most`` in all are used; their
    features (32 KB a text) meet in one task, and only the model comes to the
    driver."""
    sample = _sampled(labelled.filter(F.col("text").rlike(HAS_LETTER) & F.col("lang").isNotNull()), per_lang, most)

    def extract(batches):
        import pyarrow as pa

        from staylens.llm.words import text_buffer
        for b in batches:
            data, off = text_buffer(b.column("text"))
            for i in range(b.num_rows):
                d = data[off[i]:off[i + 1]]
                cut = _snippet(d, np.random.default_rng(len(d)))
                rows = [features(v, np.array([0, len(v)]))[0].tobytes() for v in (d, cut)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column("lang")[i].as_py()] * 2), pa.array(rows, pa.binary())], ["lang", "x"])

    def fit(batches):
        import pyarrow as pa
        rows = [r for b in batches for r in zip(b.column("lang").to_pylist(), b.column("x").to_pylist())]
        if rows:
            m = _fit(rows, dim, epochs, rate, reject_share, seed)
            cols = [[m.langs], [m.embed.tobytes()], [m.out.tobytes()], [m.bias.tobytes()], [m.temperature], [m.limit]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["langs", "embed", "out", "bias", "temperature", "limit"])

    # one task learns from the bounded sample; only the model comes back
    got = (sample.mapInArrow(extract, "lang string, x binary").repartition(1)
           .mapInArrow(fit, "langs array<string>, embed binary, out binary, bias binary, temperature double, limit double").first())
    if got is None:
        return LanguageModel()
    table = lambda raw, *shape: np.frombuffer(raw, np.float32).reshape(shape)
    n = len(got["langs"])
    return LanguageModel(list(got["langs"]), table(got["embed"], BUCKETS, dim), table(got["out"], dim, n), table(got["bias"], n),
                         got["temperature"], got["limit"])


def _fit(rows: list, dim: int, epochs: int, rate: float, reject_share: float, seed: int) -> LanguageModel:
    """The model of (lang, features) rows; a fifth of them is kept out for the
    calibration."""
    rows.sort()
    langs = sorted({lang for lang, _ in rows})
    y = np.array([langs.index(lang) for lang, _ in rows])
    x = np.stack([np.frombuffer(f, np.float32) for _, f in rows])
    rng = np.random.default_rng(seed)
    keep = rng.random(len(y)) < 0.2
    if keep.all() or not keep.any():
        keep[:] = False
        keep[::5] = True
    fit = ~keep if (~keep).any() else keep
    model = LanguageModel(langs, rng.normal(0, 1, (BUCKETS, dim)).astype(np.float32) * 4,
                          np.zeros((dim, len(langs)), np.float32), np.zeros(len(langs), np.float32))
    _descend(model, x[fit], y[fit], epochs, rate, rng)
    _calibrate(model, x[keep], y[keep], reject_share)
    return model


def _descend(m: LanguageModel, x, y, epochs: int, rate: float, rng) -> None:
    """Mini-batch gradient descent on the cross entropy, rate falling to zero.
    The embedding step is scaled by the number of buckets, since a bucket's
    share of a text is of the order of its inverse."""
    share = np.bincount(y, minlength=len(m.langs)) / len(y)
    weight = (1 / np.maximum(share, 1e-9) / np.count_nonzero(share)).astype(np.float32)
    batch, steps, step = 32, max(1, epochs * -(-len(y) // 32)), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            k = order[i:i + batch]
            h = x[k] @ m.embed
            z = h @ m.out + m.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(k)), y[k]] -= 1
            p *= weight[y[k]][:, None] / len(k)
            lr = np.float32(rate * (1 - step / steps))
            dh = p @ m.out.T
            m.out -= lr * (h.T @ p)
            m.bias -= lr * p.sum(axis=0)
            m.embed -= lr * np.float32(BUCKETS / 16) * (x[k].T @ dh)
            step += 1


def _calibrate(m: LanguageModel, x, y, reject_share: float) -> None:
    """Temperature of least cross entropy, then the probability under which
    only ``reject_share`` of the correct kept-out texts lie (0.5 at most)."""
    best = None
    for t in np.geomspace(0.2, 5, 41):
        m.temperature = float(t)
        loss = -np.log(m.probabilities(x)[np.arange(len(y)), y] + 1e-12).mean()
        if best is None or loss < best[0]:
            best = (loss, float(t))
    m.temperature = best[1]
    p = m.probabilities(x)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    m.limit = float(min(0.5, np.quantile(right, reject_share))) if len(right) else 0.0


def predictor(model: LanguageModel):
    """Arrow UDF text -> struct(lang, score); the text must hold a letter."""

    @F.arrow_udf("lang string, score double")
    def predict(text):
        import pyarrow as pa
        best, score = np.zeros(len(text), np.int64), np.zeros(len(text))
        for lo, hi, x in _blocks(text):
            p = model.probabilities(x)
            best[lo:hi], score[lo:hi] = p.argmax(axis=1), p.max(axis=1)
        langs = pa.array(model.langs, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays([langs, pa.array(np.clip(score, 0, 1))], ["lang", "score"])

    return predict


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> Column:
    """Column struct(lang, score) for ``docs``; `und` with 0 where there is no
    letter to judge by."""
    none = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    if not model.langs:
        return none
    got = predictor(model)(F.coalesce(F.col(text_col), F.lit("")))
    return F.when(F.coalesce(F.col(text_col).rlike(HAS_LETTER), F.lit(False)), got).otherwise(none)


def learn_from(docs: DataFrame, train_rows: Column, **options) -> LanguageModel:
    """Train on the rows of documents for which ``train_rows`` holds."""
    return train(docs.filter(train_rows & F.col("lang").isNotNull())
                 .select(F.col("doc_id").alias("id"), "lang", "text"), **options)


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is recognised with at least the
    model's calibrated limit."""
    p = identify(docs, model, text_col)
    return docs.filter((p["lang"] != UNKNOWN) & (p["score"] >= model.limit))
