"""Repeated word windows, found by level-wise doubling.

A window of n words that occurs twice has, at every shorter length, a sub-window
that occurs twice. So candidates are tested at a short length first, and only
windows whose short sub-window is repeated are tested again at twice that
length, up to n, where the window itself is tested. Lengths are n halved
(rounded up) until at most ``first``, in rising order: 18, 35 for n = 35.

Below n each window is tested through one sub-window: the one with the least
hash. Equal windows choose equal ones, so the test loses nothing, and
neighbouring windows mostly share their choice, so a level handles runs of
windows, about 2 / (n - length + 2) per word. Counting is a plain aggregate on
the hash (combined before the shuffle, so a passage in a third of all texts is
no hot task).

At the last level every window of a surviving run is hashed whole. Runs are
dealt to bounded blocks by their sub-window's hash; runs whose sub-window is
very frequent (over ``HOT``) are counted with an aggregate and a join instead,
equal runs together.

Windows are compared by 64-bit hashes of word sequences, split by a second
64-bit hash.

Defined results: words are the runs of bytes other than white space; null and
empty texts have none; a text under n words has no window; occurrences in one
text, in equal rows, and overlapping ones all count; texts are read whole; an
empty table gives an empty result. Rows are told apart by (id, md5 of the
text); rows equal in both get the same result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import text_mark, written

#: Runs of one sub-window up to which they are compared in one group (some ten
#: MB), and the mean number of runs that share a group.
HOT = 50_000
BLOCK_RUNS = 4096


def level_lengths(n: int, first: int) -> list[int]:
    out = [n]
    while out[0] > first:
        out.insert(0, -(-out[0] // 2))
    return out


def _pieces(batch):
    """For pieces of the batch's texts: (first row, bytes, word starts, word
    ends, word hashes, words per row)."""
    from staylens.llm.words import pieces, text_buffer, word_bounds, word_hashes
    for lo, _, data, off in pieces(*text_buffer(batch.column("text"))):
        s, e, counts = word_bounds(data, off)
        yield lo, data, s, e, word_hashes(data, s, e), counts


def _window_mask(counts: np.ndarray, n: int) -> np.ndarray:
    """For every word: does a window of n words of its text start here?"""
    total = int(counts.sum())
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return left >= n


def _least(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, value) of the least of every k consecutive values, the first
    of equal ones."""
    m = len(h) - k + 1
    best, at = h[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, k):
        c = h[j:j + m]
        better = c < best
        best[better] = c[better]
        at[better] = j
    return at + np.arange(m), best


def _runs(words: np.ndarray, counts: np.ndarray, alive: np.ndarray, n: int, length: int):
    """Runs of live windows with the same least sub-window: (row of the piece,
    first window counted from the row's first word, windows, sub-window hash)."""
    from staylens.llm.words import window_hashes
    z = np.zeros(0, np.int64)
    sub = window_hashes(words, length)
    k = n - length + 1
    if len(sub) < k:
        return z, z, z, z.view(np.uint64)
    at, value = _least(sub, k)
    p = np.flatnonzero(alive[:len(at)])
    if not len(p):
        return z, z, z, z.view(np.uint64)
    row = np.repeat(np.arange(len(counts)), counts)[p]
    new = np.ones(len(p), bool)
    new[1:] = (at[p][1:] != at[p][:-1]) | (np.diff(p) != 1) | (np.diff(row) != 0)
    head = np.flatnonzero(new)
    first = np.cumsum(counts) - counts
    return row[head], p[head] - first[row[head]], np.diff(np.append(head, len(p))), value[p[head]]


def _alive(batch, lo: int, counts: np.ndarray, n: int) -> np.ndarray:
    """Windows still in the race: all, or those of the row's surviving runs."""
    mask = _window_mask(counts, n)
    if "runs" not in batch.schema.names:
        return mask
    live = np.zeros(len(mask) + 1, np.int64)
    first = np.cumsum(counts) - counts
    runs = batch.column("runs")
    for i in range(len(counts)):
        for r in runs[lo + i].as_py():
            live[first[i] + r["lo"]] += 1
            live[first[i] + r["lo"] + r["n"]] -= 1
    return mask & (np.cumsum(live[:-1]) > 0)


def _level(docs: DataFrame, n: int, length: int) -> DataFrame:
    """Runs of candidate windows: (sub, id, crc, lo, n)."""

    def emit(batches):
        import pyarrow as pa
        for b in batches:
            for lo, _, _, _, words, counts in _pieces(b):
                row, first, size, sub = _runs(words, counts, _alive(b, lo, counts, n), n, length)
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sub.view(np.int64)), b.column("id").take(take), b.column("crc").take(take),
                     pa.array(first.astype(np.int32)), pa.array(size.astype(np.int32))], ["sub", "id", "crc", "lo", "n"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(emit, f"sub long, id {kind}, crc binary, lo int, n int")


def _survivors(level: DataFrame) -> DataFrame:
    """Per text, the runs whose sub-window occurs more than once: (id, crc,
    runs of (lo, n, hot))."""
    # a table, so that both sides of the join are dealt out for it alone and a
    # frequent sub-window can be split
    often = written(level.groupBy("sub").agg(F.count("*").alias("c")).filter("c > 1"), "often")
    return (level.join(often, "sub").groupBy("id", "crc")
            .agg(F.collect_set(F.struct("lo", "n", (F.col("c") > HOT).alias("hot"))).alias("runs")))


def _with_runs(docs: DataFrame, runs: DataFrame, how: str = "inner") -> DataFrame:
    r = runs.withColumnRenamed("id", "_id").withColumnRenamed("crc", "_crc")
    return docs.join(r, docs["id"].eqNullSafe(r["_id"]) & (docs["crc"] == r["_crc"]), how).drop("_id", "_crc")


def _last_level(docs: DataFrame, n: int, length: int, blocks: int) -> DataFrame:
    """Repeated windows: (id, crc, spans of (first window, windows in a row)),
    one row a run."""
    kind = docs.schema["id"].dataType.simpleString()

    def runs_of(batch, hot: bool):
        """Surviving runs of one kind with the hashes of their windows."""
        import pyarrow as pa

        from staylens.llm.words import window_hashes
        runs = batch.column("runs")
        keep = pa.array([[r for r in x if r["hot"] == hot] for x in runs.to_pylist()], runs.type)
        part = pa.RecordBatch.from_arrays([batch.column("text"), keep], ["text", "runs"])
        for lo, _, _, _, words, counts in _pieces(part):
            row, first, size, sub = _runs(words, counts, _alive(part, lo, counts, n), n, length)
            whole = window_hashes(words, n)
            start = (np.cumsum(counts) - counts)[row] + first
            yield row + lo, first, size, sub, whole, start

    def emit(batches):
        import pyarrow as pa
        for b in batches:
            for row, first, size, sub, whole, start in runs_of(b, False):
                flat = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else start, size) + np.arange(size.sum())
                hashes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                                  pa.array(whole[flat].view(np.int64)))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((sub % np.uint64(blocks)).astype(np.int64)), pa.array(sub.view(np.int64)),
                     b.column("id").take(take), b.column("crc").take(take), pa.array(first.astype(np.int32)), hashes],
                    ["block", "sub", "id", "crc", "lo", "hashes"])

    def judge(t):
        import pyarrow as pa

        from staylens.llm.words import mix
        lists = t.column("hashes").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        run = np.repeat(np.arange(len(size)), size)
        sub = t.column("sub").to_numpy().view(np.uint64)
        key = mix(lists.flatten().to_numpy().view(np.uint64) ^ (sub[run] * np.uint64(0x9E3779B97F4A7C15)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[inverse] > 1
        start = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
        first = t.column("lo").to_numpy()[run] + np.arange(len(run)) - start[run]
        edge = np.ones(len(run), bool)
        edge[1:] = (run[1:] != run[:-1]) | ~again[:-1]
        head = np.flatnonzero(again & edge)
        upto = np.cumsum(again)
        tail = np.append(upto[head[1:] - 1] if len(head) > 1 else [], upto[-1] if len(upto) else 0)[:len(head)]
        length_of = tail - upto[head] + 1
        take = pa.array(run[head])
        return pa.table({"id": t.column("id").take(take), "crc": t.column("crc").take(take),
                         "lo": pa.array(first[head].astype(np.int32)), "n": pa.array(length_of.astype(np.int32))})

    def emit_hot(batches):
        import pyarrow as pa

        from staylens.llm.words import mix
        for b in batches:
            for row, first, size, sub, whole, start in runs_of(b, True):
                windows = [whole[a:a + k] for a, k in zip(start, size)]
                key = [int(mix(w + np.arange(len(w), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64).view(np.int64))
                       for w in windows]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sub.view(np.int64)), pa.array(key, pa.int64()), b.column("id").take(take), b.column("crc").take(take),
                     pa.array(first.astype(np.int32)), pa.array([w.view(np.int64) for w in windows], pa.list_(pa.int64()))],
                    ["sub", "key", "id", "crc", "lo", "hashes"])

    plain = (docs.mapInArrow(emit, f"block long, sub long, id {kind}, crc binary, lo int, hashes array<long>")
             .groupBy("block").applyInArrow(judge, f"id {kind}, crc binary, lo int, n int")
             .select("id", "crc", F.array(F.struct("lo", "n")).alias("spans")))
    # frequent sub-windows: equal runs are one kind, so a passage in very many
    # texts is counted and looked up once, and texts get one row a run
    hot = docs.filter(F.exists("runs", lambda r: r["hot"])).mapInArrow(
        emit_hot, f"sub long, key long, id {kind}, crc binary, lo int, hashes array<long>")
    kinds = hot.groupBy("sub", "key", "hashes").agg(F.count("*").alias("c"))
    windows = kinds.select("sub", "key", "c", F.posexplode("hashes").alias("j", "whole"))
    often = windows.groupBy("sub", "whole").agg(F.sum("c").alias("c")).filter("c > 1").drop("c")
    again = windows.join(often, ["sub", "whole"]).groupBy("sub", "key").agg(F.collect_set("j").alias("js"))
    found = hot.select("sub", "key", "id", "crc", "lo").join(again, ["sub", "key"]).select(
        "id", "crc", F.transform("js", lambda j: F.struct((F.col("lo") + j).alias("lo"), F.lit(1).alias("n"))).alias("spans"))
    return plain.union(found)


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 35, first: int = 18):
    """(docs as (id, crc, text, ...), repeated windows per text): the second is
    (id, crc, spans) with spans the list of (first window, windows in a row)."""
    keyed = docs.select(F.col(id_col).alias("id"), text_mark(F.col(text_col)).alias("crc"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lengths = level_lengths(n, first)
    alive, runs = keyed, None
    for length in lengths[:-1] or [lengths[0]]:
        runs = written(_survivors(_level(alive, n, length)), f"windows-{length}")
        alive = _with_runs(keyed, runs)
    n_runs = runs.agg(F.sum(F.size("runs"))).first()[0] or 0
    found = _last_level(alive, n, lengths[-2] if len(lengths) > 1 else n, max(1, -(-n_runs // BLOCK_RUNS)))
    return keyed, found.groupBy("id", "crc").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept(batch, n: int):
    """Per text: (row, words, kept words as bytes)."""
    from staylens.llm.words import text_buffer
    data, off = text_buffer(batch.column("text"))
    spans = batch.column("spans")
    for i in range(batch.num_rows):
        words = data[off[i]:off[i + 1]].tobytes().split()
        found = spans[i].as_py()
        if not found:
            yield i, words, words
            continue
        cover = np.zeros(len(words) + 1, np.int64)
        for s in found:
            cover[s["lo"]] += 1
            cover[s["lo"] + s["n"] + n - 1] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        yield i, words, [w for w, g in zip(words, gone) if not g]


def digest(docs: DataFrame, n: int = 35, first: int = 18) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every text of ``docs``
    (doc_id, text) without the words of repeated windows."""
    keyed, spans = repeated_windows(docs, n=n, first=first)
    kind = keyed.schema["id"].dataType.simpleString()

    def hashed(batches):
        import pyarrow as pa
        for b in batches:
            rows = [(len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for _, w, k in _kept(b, n)]
            cols = [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_runs(keyed, spans, "left").mapInArrow(
        hashed, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 35, first: int = 18) -> DataFrame:
    """``docs`` with the words of repeated windows taken out of ``text_col``.
    A changed text is its kept words joined by spaces, so a text that loses all
    of them is empty; untouched texts and the number of rows stay as they are."""
    _, spans = repeated_windows(docs, id_col, text_col, n, first)
    r = spans.select(F.col("id").alias("_id"), F.col("crc").alias("_crc"), F.col("spans").alias("_spans"))
    crc = text_mark(docs[text_col])
    joined = docs.join(r, docs[id_col].eqNullSafe(r["_id"]) & (crc == r["_crc"]), "left")

    @F.arrow_udf("string")
    def kept(text, spans):
        import pyarrow as pa
        b = pa.RecordBatch.from_arrays([text, spans], ["text", "spans"])
        return pa.array([b" ".join(k).decode("utf-8", "replace") for _, _, k in _kept(b, n)], pa.string())

    joined = joined.withColumn("_new", F.when(F.col("_spans").isNull(), F.col(f"`{text_col}`")).otherwise(
        kept(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.coalesce("_spans", F.array().cast(r.schema["_spans"].dataType)))))
    return joined.select(*[F.col("_new").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
