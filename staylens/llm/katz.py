"""Language model scores by Katz backoff.

Word counts are Good-Turing discounted and the mass taken away goes to the
class of unknown words. Pair counts are discounted likewise; what a context's
pairs leave goes to the words not seen after it, in proportion to their word
probability, with the exact factor

    alpha(h) = (1 - sum of P(w|h) over seen w) / (1 - sum of P(w) over seen w)

so every context sums to 1. A token is scored by its pair if seen, else by
alpha times its word, else by the unknown class.

The word counts are a written table. All tokens then meet once, dealt by their
context into parts of a bounded number of tokens: a task packs its tokens of a
part into one row (context and word hashes once each, two small numbers a
token). Contexts with a large share of all tokens are dealt by context and
word, and their sums are put together first. The first reading of the parts
gives the counts of pair counts, the second scores; both read the same shuffle.

A task cuts its texts into blocks, and within a block a text is a small number:
ids, token counts and base scores go along once a block, as its directory, and
what comes back from a part is one row a block. Arrays travel as byte planes,
compressed, and partial sums as whole numbers of 2**-30, so little is shuffled
for a text however many parts its tokens are dealt to.

Defined results: words are runs of bytes other than white space, A-Z folded;
null and empty texts are one end token; without training rows every word is
unknown and the score is 0 a token; texts are read whole; equal rows get equal
scores; other columns are ignored. A task that is run again must read its rows
in the same order, as scans of files do; otherwise the tokens of a block don't
add up to its directory's, and the job fails instead of mixing scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import written

K = 5
START, END = np.uint64(0x5151515151515151), np.uint64(0xE0E0E0E0E0E0E0E1)
HOT_SHARE = 256
PART_TOKENS = 2_000_000
BLOCK_TOKENS = 2_000_000
#: Partial sums are whole numbers of 1 / SCALE.
SCALE = 2.0 ** 30
#: Up to so many distinct words their counts go to every task; beyond, texts
#: are joined with the counts of their own words.
MAX_BROADCAST_WORDS = 16_000_000


def _tokens(column):
    """For pieces of an Arrow text column: (first row, token hashes with an end
    after every text, tokens per row)."""
    from staylens.llm.words import pieces, text_buffer, word_bounds, word_hashes
    for lo, _, data, off in pieces(*text_buffer(column)):
        s, e, counts = word_bounds(data, off)
        words = word_hashes(data, s, e, lower=True)
        yield lo, np.insert(words, np.cumsum(counts), END), counts + 1


def word_counts(texts: DataFrame) -> DataFrame:
    """(word hash, c) over the tokens of ``texts``; summed in each task first."""

    def count(batches):
        import pyarrow as pa
        keys, values, size = [], [], 0

        def merged():
            w, at = np.unique(np.concatenate(keys), return_inverse=True)
            return w, np.bincount(at, np.concatenate(values), len(w)).astype(np.int64)

        for b in batches:
            for _, words, _ in _tokens(b.column("text")):
                w, c = np.unique(words, return_counts=True)
                keys.append(w)
                values.append(c)
                size += len(w)
                if size > 2_000_000:
                    w, c = merged()
                    keys, values, size = [w], [c], 0
                    if len(w) > 2_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], ["word", "c"])
                        keys, values = [], []
        if keys:
            w, c = merged()
            for i in range(0, len(w), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[i:i + 100_000].view(np.int64)), pa.array(c[i:i + 100_000])], ["word", "c"])

    return texts.select("text").mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def discounts(of: dict[int, int]) -> np.ndarray:
    """Good-Turing factors for counts 0..K+1 (1 from K+1 on), from how many
    types have each count; 1 where the estimate is not usable."""
    d = np.ones(K + 2)
    n = [of.get(r, 0) for r in range(K + 2)]
    if n[1]:
        a = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            if n[r] and a < 1:
                x = ((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a)
                if 0 < x < 1:
                    d[r] = x
    return d


@dataclass
class Words:
    """The word level: discounted probabilities by count, unknown class."""

    n: int
    v: int
    d: np.ndarray
    scale: float
    unknown: float

    def p(self, c: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(c))
        seen = self.scale * self.d[np.minimum(c, K + 1)] * c / self.n
        return np.where(c > 0, seen, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.n + self.v + 1))


def word_level(counts: DataFrame) -> Words:
    got = {r["r"]: (r["types"], r["tokens"]) for r in counts.groupBy(F.least("c", F.lit(K + 2)).alias("r")).agg(
        F.count("*").alias("types"), F.sum("c").alias("tokens")).collect()}
    n, v = sum(t for _, t in got.values()), sum(t for t, _ in got.values())
    d = discounts({r: t for r, (t, _) in got.items() if r <= K + 1})
    if not n:
        return Words(0, 0, d, 1.0, 1.0)
    used = sum(d[min(r, K + 1)] * tokens for r, (_, tokens) in got.items()) / n
    least = 1 / (n + 1)
    unknown = max(1 - used, least)
    return Words(n, v, d, (1 - unknown) / used, unknown)


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(asked), np.int64)
    w, at = np.unique(asked, return_inverse=True)
    i = np.minimum(np.searchsorted(keys, w), len(keys) - 1)
    return np.where(keys[i] == w, values[i], 0).astype(np.int64)[at]


def _with_counts(texts: DataFrame, counts: DataFrame):
    """(texts, reader): ``reader(batch, first row, tokens, tokens per row)``
    gives the training count of every token."""
    sc = texts.sparkSession.sparkContext
    if counts.count() <= MAX_BROADCAST_WORDS:
        got = counts.toArrow()
        w = got.column("word").to_numpy().view(np.uint64)
        order = np.argsort(w)
        c = got.column("c").to_numpy()[order]
        both = sc.broadcast((w[order], c.astype(np.uint32) if len(c) and c.max() < 1 << 32 else c))
        del got, w, c
        return texts, lambda batch, lo, words, rows: _look_up(*both.value, words)

    def distinct(batches):
        import pyarrow as pa
        for b in batches:
            for lo, words, rows in _tokens(b.column("text")):
                row = np.repeat(np.arange(len(rows)), rows)
                order = np.lexsort((words, row))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(row[order]) != 0) | (words[order][1:] != words[order][:-1])
                take = pa.array(row[order][new] + lo)
                yield pa.RecordBatch.from_arrays([b.column("id").take(take), b.column("crc").take(take),
                                                  pa.array(words[order][new].view(np.int64))], ["id", "crc", "word"])

    kind = texts.schema["id"].dataType.simpleString()
    own = (texts.mapInArrow(distinct, f"id {kind}, crc long, word long").distinct().join(counts, "word")
           .groupBy(F.col("id").alias("_id"), F.col("crc").alias("_crc")).agg(F.collect_list(F.struct("word", "c")).alias("own")))
    joined = texts.join(own, texts["id"].eqNullSafe(own["_id"]) & (texts["crc"] == own["_crc"]), "left").drop("_id", "_crc")
    joined = joined.sortWithinPartitions("id", "crc")  # the same blocks if a task is run again

    def read(batch, lo, words, rows):
        out, at = [], 0
        for i, n in enumerate(rows):
            mine = sorted((x["word"], x["c"]) for x in batch.column("own")[lo + i].as_py() or [])
            keys = np.array([k for k, _ in mine], np.int64).view(np.uint64)
            order = np.argsort(keys)
            out.append(_look_up(keys[order], np.array([c for _, c in mine], np.int64)[order], words[at:at + n]))
            at += n
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    return joined, read


def _n_tokens(texts: DataFrame) -> int:
    """Tokens of all texts."""

    def count(batches):
        import pyarrow as pa

        from staylens.llm.words import pieces, text_buffer, word_bounds
        n = 0
        for b in batches:
            for _, _, data, off in pieces(*text_buffer(b.column("text"))):
                n += int((word_bounds(data, off)[2] + 1).sum())
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

    return texts.select("text").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def _planes(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes, of each first all lowest ones, then the next; the high
    bytes of small numbers then compress to nothing."""
    return b"".join(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays)


def _from_planes(raw: memoryview, kinds):
    """The arrays of ``_planes``, given (length, type) of each."""
    at = 0
    for n, kind in kinds:
        size = np.dtype(kind).itemsize
        yield np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).reshape(-1).view(kind)
        at += n * size


def _pack(texts: DataFrame, read, level: Words, hot: np.ndarray, parts: int) -> DataFrame:
    """Rows (part, block, n, size, packed): the tokens of a block of texts that
    belong to a part; and a row a block with its directory (ids, train, tokens,
    known, base), under a part of its own from ``parts`` on."""

    def emit(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from staylens.llm.words import mix
        codec = pa.Codec("zstd", 1)
        number = TaskContext.get().partitionId() << 32
        block, held = [], 0
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)

        def flush():
            ids = pa.concat_arrays([x[0] for x in block])
            train, w, c, rows = (np.concatenate([x[j] for x in block]) for j in (1, 2, 3, 4))
            start = np.cumsum(rows) - rows
            listed = [one(ids), *(one(pa.array(x)) for x in (
                train, rows, np.add.reduceat((c > 0).astype(np.int64), start), np.add.reduceat(level.base(c), start)))]
            nothing = [pa.nulls(1, x.type) for x in listed]
            yield pa.RecordBatch.from_arrays(
                [pa.array([parts + number]), pa.array([number]), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int64()),
                 pa.nulls(1, pa.binary()), *listed], names)
            doc = np.repeat(np.arange(len(rows), dtype=np.uint32), rows)
            h = np.empty_like(w)
            h[1:] = w[:-1]
            h[start] = START
            key = mix(h)
            spread = np.isin(h, hot)
            key[spread] = mix(key[spread] ^ w[spread])
            part = (key % np.uint64(parts)).astype(np.int32)
            del key, spread
            order = np.lexsort((w, h, part))
            edge = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(edge)):
                o = order[edge[p]:edge[p + 1]]
                hs, size = np.unique(h[o], return_counts=True)
                ws, first, at = np.unique(w[o], return_index=True, return_inverse=True)
                ds, doc_at = np.unique(doc[o], return_inverse=True)
                raw = _planes(hs, size.astype(np.uint32), ws, c[o][first].astype(np.int64), at.astype(np.uint32),
                              doc_at.astype(np.uint32), np.diff(ds, prepend=np.uint32(0)).astype(np.uint32), train[ds])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([number]), pa.array([[len(hs), len(ws), len(o), len(ds)]], pa.list_(pa.int64())),
                     pa.array([len(raw)]), pa.array([codec.compress(raw, asbytes=True)], pa.binary()), *nothing], names)

        for b in batches:
            for lo, words, rows in _tokens(b.column("text")):
                n = len(rows)
                block.append((b.column("id").slice(lo, n), b.column("train").slice(lo, n).to_numpy(zero_copy_only=False).astype(bool),
                              words, read(b, lo, words, rows), rows))
                held += len(words)
                if held >= BLOCK_TOKENS:
                    yield from flush()
                    block, held = [], 0
                    number += 1
        if block:
            yield from flush()

    kind = texts.schema["id"].dataType.simpleString()
    names = ["part", "block", "n", "size", "packed", "ids", "train", "tokens", "known", "base"]
    return texts.mapInArrow(emit, "part long, block long, n array<long>, size long, packed binary, "
                                  f"ids array<{kind}>, train array<boolean>, tokens array<long>, known array<long>, base array<double>")


def _unpack(t):
    """The tokens of a part: (context, word, word count, text number, train by
    text number, [(block, the block's numbers of its texts)])."""
    import pyarrow as pa
    codec = pa.Codec("zstd")
    h, w, c, doc, train, texts, base = [], [], [], [], [], [], 0
    for block, n, size, packed in zip(*(t.column(x).to_pylist() for x in ("block", "n", "size", "packed"))):
        raw = memoryview(codec.decompress(packed, size, asbytes=True))
        hs, times, ws, cs, at, doc_at, ds, flags = _from_planes(raw, (
            (n[0], np.uint64), (n[0], np.uint32), (n[1], np.uint64), (n[1], np.int64), (n[2], np.uint32), (n[2], np.uint32),
            (n[3], np.uint32), (n[3], np.bool_)))
        h.append(np.repeat(hs, times))
        w.append(ws[at])
        c.append(cs[at])
        doc.append(doc_at.astype(np.int64) + base)
        train.append(flags)
        texts.append((block, np.cumsum(ds)))
        base += len(flags)

    def cat(parts):
        """One array of the parts, which are given up."""
        whole = np.concatenate(parts)
        parts.clear()
        return whole

    return cat(h), cat(w), cat(c), cat(doc), cat(train), texts


def _pairs(h, w, c, train_token):
    """Distinct pairs of a part: (pair number of each token, pair count in
    training, context number of each pair, contexts, word count of each pair)."""
    from staylens.llm.words import mix
    _, first, at = np.unique(mix(h) ^ w, return_index=True, return_inverse=True)
    count = np.bincount(at, train_token, len(first)).astype(np.int64)
    contexts, of = np.unique(h[first], return_inverse=True)
    return at, count, of, contexts, c[first]


def _sums(count, of, contexts, p_word) -> np.ndarray:
    """Per context: pairs seen 1..K times, tokens of pairs seen more often, and
    the word probability of all seen words."""
    out = np.zeros((len(contexts), K + 2))
    for r in range(1, K + 1):
        out[:, r - 1] = np.bincount(of, count == r, len(contexts))
    out[:, K] = np.bincount(of, np.where(count > K, count, 0), len(contexts))
    out[:, K + 1] = np.bincount(of, np.where(count > 0, p_word, 0.0), len(contexts))
    return out


def _context_terms(sums: np.ndarray, d: np.ndarray):
    """(tokens, scale of the seen pairs, log10 alpha) of contexts."""
    r = np.arange(1, K + 1)
    tokens = sums[:, :K] @ r + sums[:, K]
    seen = np.where(tokens > 0, (sums[:, :K] @ (r * d[1:K + 1]) + sums[:, K]) / np.maximum(tokens, 1), 0.0)
    # a context without rare pairs leaves nothing: it gives up one count
    left = np.where(1 - seen > 1e-9, 1 - seen, 1 / (tokens + 1))
    scale = np.where(tokens > 0, (1 - left) / np.maximum(seen, 1e-300), 1.0)
    alpha = np.where(tokens > 0, left / np.maximum(1 - sums[:, K + 1], 1e-300), 1.0)
    return tokens, scale, np.log10(alpha)


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text of ``docs`` with the model of the rows for which
    ``train`` holds: (id, train, n_tokens, n_known, train_tokens, base_score,
    score), logarithms to base 10."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("crc"), train.alias("train"), text.alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    counts = written(word_counts(texts.filter("train")), "word-counts")
    level = word_level(counts)
    frequent = counts.filter(F.col("c") > max(1, level.n // HOT_SHARE)).select("word").collect()
    hot = np.array([START, *(np.int64(r["word"]).astype(np.uint64) for r in frequent)], np.uint64)
    parts = max(1, -(-_n_tokens(texts) // PART_TOKENS))
    texts, read = _with_counts(texts, counts)
    packed = _pack(texts, read, level, hot, parts).repartition("part")

    model_columns = ["context", *[f"s{i}" for i in range(K + 2)]]
    lists = ["ids", "train", "tokens", "known", "base"]

    def survey(t):
        """How many pairs have each count, and the hot contexts' sums."""
        import pyarrow as pa
        if t.column("part")[0].as_py() >= parts:
            return pa.table({k: pa.array([0], pa.int64() if k == "context" else pa.float64()) for k in model_columns})
        h, w, c, doc, tr, _ = _unpack(t)
        _, count, of, contexts, cw = _pairs(h, w, c, tr[doc])
        del h, w, c, doc
        sums = _sums(count, of, contexts, level.p(cw))
        some = np.isin(contexts, hot)
        n = np.bincount(np.minimum(count, K + 2), minlength=K + 3)[1:K + 2].astype(float)
        rows = np.vstack([np.append(n, 0.0), sums[some]])
        return pa.table({"context": pa.array(np.append(np.uint64(0), contexts[some]).view(np.int64)),
                         **{f"s{i}": pa.array(rows[:, i]) for i in range(K + 2)}})

    # no filter on the directories' rows: it would sink below the exchange, which then serves one reader only
    surveyed = (packed.groupBy("part")
                .applyInArrow(survey, "context long, " + ", ".join(f"s{i} double" for i in range(K + 2)))
                .groupBy("context").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(K + 2)])
                .agg(F.collect_list(F.struct(*model_columns)).alias("model")))

    def evaluate(t):
        import pyarrow as pa
        if t.column("part")[0].as_py() >= parts:
            nothing = {k: pa.nulls(len(t), kind) for k, kind in (("found", pa.int64()), ("n", pa.int64()), ("packed", pa.binary()))}
            return pa.table({"block": t.column("block"), **nothing, **{k: t.column(k) for k in lists}})
        model = t.column("model")[0].as_py()
        own = {r["context"]: [r[f"s{i}"] for i in range(K + 2)] for r in model}
        d = discounts({r: int(x) for r, x in enumerate(own.pop(0, [0] * (K + 2))[:K + 1], 1)})
        h, w, c, doc, tr, texts = _unpack(t)
        at, count, of, contexts, cw = _pairs(h, w, c, tr[doc])
        del h, w, c
        p_word = level.p(cw)
        sums = _sums(count, of, contexts, p_word)
        for i, k in enumerate(contexts.view(np.int64).tolist()):
            if k in own:
                sums[i] = own[k]
        tokens, scale, alpha = _context_terms(sums, d)
        seen = scale[of] * d[np.minimum(count, K + 1)] * count / np.maximum(tokens[of], 1)
        log_p = np.where(count > 0, np.log10(np.maximum(seen, 1e-300)), alpha[of] + np.log10(p_word))
        total = np.rint(np.bincount(doc, log_p[at], len(tr)) * SCALE).astype(np.int64)
        many = np.bincount(doc, minlength=len(tr))
        codec, rows, base = pa.Codec("zstd", 1), [], 0
        for block, ds in texts:
            here = slice(base, base + len(ds))
            raw = _planes(np.diff(ds, prepend=0).astype(np.uint32), total[here])
            rows.append((block, int(many[here].sum()), len(ds), codec.compress(raw, asbytes=True)))
            base += len(ds)
        sent = {k: pa.array(x, kind) for k, x, kind in zip(
            ("block", "found", "n", "packed"), zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))}
        return pa.table({**sent, **{k: pa.nulls(len(rows), t.column(k).type) for k in lists}})

    def whole(t):
        """The texts of a block with the sums of all parts."""
        import pyarrow as pa
        where = [i for i, x in enumerate(t.column("ids")) if x.is_valid]
        tokens = t.column("tokens")[where[0]].values.to_numpy()
        score, found, codec = np.zeros(len(tokens), np.int64), 0, pa.Codec("zstd")
        for m, n, packed in zip(*(t.column(x).to_pylist() for x in ("found", "n", "packed"))):
            if packed is not None:
                ds, sums = _from_planes(memoryview(codec.decompress(packed, n * 12, asbytes=True)), ((n, np.uint32), (n, np.int64)))
                score[np.cumsum(ds)] += sums
                found += m
        if len(where) != 1 or found != tokens.sum():
            raise RuntimeError("the texts came in another order when a task was run again: write them as a table first")
        return pa.table({"id": t.column("ids")[where[0]].values, "train": t.column("train")[where[0]].values, "n_tokens": pa.array(tokens),
                         "n_known": t.column("known")[where[0]].values, "base_score": t.column("base")[where[0]].values,
                         "score": pa.array(score / SCALE)})

    listed = f"ids array<{kind}>, train array<boolean>, tokens array<long>, known array<long>, base array<double>"
    of_parts = (packed.withColumn("model", surveyed.scalar()).groupBy("part")
                .applyInArrow(evaluate, f"block long, found long, n long, packed binary, {listed}"))
    return (of_parts.groupBy("block")
            .applyInArrow(whole, f"id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
            .select("id", "train", "n_tokens", "n_known", F.lit(level.n).cast("long").alias("train_tokens"), "base_score", "score"))
