"""Jaccard similarity join on word shingles by chosen paths.

Every text is the set of its hashed shingles; texts with equal sets are one
class. A class is embedded as ``COORDS`` min-hash tokens (i, h_i): two classes
of similarity s share a token with probability s. One run samples a token,
splits all classes by it, and splits every bucket that is still large again by
tokens sampled from the bucket's own hash, so both members of a pair walk the
same path. A bucket is left for comparing when it is small, or when splitting
no longer shrinks it (its members are alike). ``runs`` independent runs give
the recall: a pair of similarity 0.8 is missed by one split with probability
0.2, by ten runs with about 1e-7, and by a few more when its buckets are split
again.

A pair is compared in the first bucket it shares and in no other. Members with
a partner whose tokens agree often enough (five standard deviations under the
threshold) are sent there with their whole sets, and the exact similarity
decides. Large buckets are dealt out as pairs of blocks. A bucket returns link
counts per class and a forest that connects what is linked, never the pairs;
the forest's components are the groups.

Defined results: words are runs of bytes other than white space; a text under
``shingle`` words (null and empty too) has no shingle and links with nothing;
equal rows are copies of one another; texts are read whole; an empty table
gives an empty result; other columns are ignored. Rows are told apart by (id,
crc: the text's `text_mark`).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import components, forest, text_mark, written

COORDS, SMALL, BLOCK, CHILDREN, SHRINK = 64, 256, 1024, 2, 0.5
_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def _sets(column, k: int):
    """For pieces of an Arrow text column: (first row, list of sorted shingle
    sets)."""
    from staylens.llm.words import pieces, text_buffer, window_hashes, word_bounds, word_hashes
    for lo, _, data, off in pieces(*text_buffer(column), 1 << 19):
        s, e, counts = word_bounds(data, off)
        words = word_hashes(data, s, e)
        grams = window_hashes(words, k)
        first = np.cumsum(counts) - counts
        yield lo, [np.unique(grams[f:f + n - k + 1]) if n >= k else np.zeros(0, np.uint64) for f, n in zip(first, counts)]


def _tokens(sets: list) -> np.ndarray:
    """Min-hash tokens (rows x COORDS, uint32) of non-empty sets."""
    flat, start = np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets[:-1]])
    out = np.empty((len(sets), COORDS), np.uint32)
    for i in range(COORDS):
        out[:, i] = np.minimum.reduceat((flat * _A[i] + _B[i]) >> np.uint64(32), start)
    return out


def _embed(docs: DataFrame, k: int) -> DataFrame:
    """(id, crc, set key, size, tokens) of every text; null key without shingles."""

    def embed(batches):
        import pyarrow as pa

        from staylens.llm.words import mix
        for b in batches:
            for lo, sets in _sets(b.column("text"), k):
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, sketch = [None] * len(sets), [None] * len(sets)
                if full:
                    rows = _tokens([sets[i] for i in full])
                    for i, row in zip(full, rows):
                        h = mix(sets[i])
                        keys[i] = h.sum(dtype=np.uint64).tobytes() + mix(h ^ _A[0]).sum(dtype=np.uint64).tobytes()
                        sketch[i] = row.tobytes()
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, n), b.column("crc").slice(lo, n), pa.array(keys, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(sketch, pa.binary())],
                    ["id", "crc", "key", "size", "tokens"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(embed, f"id {kind}, crc binary, key binary, size long, tokens binary")


def _split(rows: DataFrame, first: bool, runs: int) -> DataFrame:
    """Children (bucket, parent count, node, tokens) of ``rows`` (bucket, c,
    node, tokens): by one token for each of ``runs`` at the root, else by
    CHILDREN tokens chosen by the bucket."""

    def split(batches):
        import pyarrow as pa

        from staylens.llm.words import mix
        for b in batches:
            t = np.frombuffer(b"".join(b.column("tokens").to_pylist()), np.uint32).reshape(-1, COORDS)
            bucket = b.column("bucket").to_numpy().view(np.uint64)
            for j in range(runs if first else CHILDREN):
                pick = np.full(len(t), j % COORDS) if first else (mix(bucket + np.uint64(j + 1)) % np.uint64(COORDS)).astype(np.int64)
                token = t[np.arange(len(t)), pick].astype(np.uint64)
                child = mix(mix(bucket ^ np.uint64(j * 2654435761 + 97)) + (token << np.uint64(6)) + pick.astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), b.column("c"), b.column("node")],
                                                 ["bucket", "parent", "node"])

    return rows.mapInArrow(split, "bucket long, parent long, node long")


def _buckets(classes: DataFrame, runs: int, rounds: int = 40) -> DataFrame:
    """Buckets to compare, (bucket, c, node): c members, at least 2."""
    sketches = classes.select("node", "tokens")
    rows = sketches.withColumn("bucket", F.lit(0).cast("long")).withColumn("c", F.lit(1 << 60).cast("long"))
    done = None
    for level in range(rounds):
        children = _split(rows, level == 0, runs).distinct()
        counts = children.groupBy("bucket").agg(F.count("*").alias("c")).filter("c > 1")
        sized = written(children.join(counts, "bucket"), "buckets")
        large = (F.col("c") > SMALL) & (F.col("c") <= F.col("parent") * SHRINK)
        part = sized.filter(~large).select("bucket", "c", "node")
        done = part if done is None else done.union(part)
        todo = sized.filter(large).select("bucket", "c", "node")
        if todo.isEmpty():
            return done
        rows = todo.join(sketches, "node").select("node", "tokens", "bucket", "c")
    return done.union(todo)


def _cells(buckets: DataFrame) -> DataFrame:
    """Deal buckets out as cells: (cell, bucket, node, left, right). A bucket of
    at most BLOCK members is one cell in which all are on both sides; a larger
    one is cut into g blocks and every pair of blocks is a cell."""
    g = F.ceil(F.col("c") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("g")).cast("int")
    pair = F.explode(F.sequence(F.lit(0), F.col("g") - 1))
    b = buckets.withColumn("g", g).withColumn("own", own).withColumn("other", pair)
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return b.select(F.xxhash64("bucket", low, high).alias("cell"), "bucket", "node",
                    (F.col("own") == low).alias("left"), (F.col("own") == high).alias("right"))


def _compare(cells: DataFrame, n_blocks: int, fn, out: str) -> DataFrame:
    """Apply ``fn`` (one cell's Arrow rows) to every cell; many cells share a
    task group, none is divided."""

    def block(t):
        import pyarrow as pa
        cell = t.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        t = t.take(pa.array(order))
        edges = np.concatenate([[0], np.flatnonzero(np.diff(cell[order])) + 1, [len(order)]])
        return pa.concat_tables([fn(t.slice(a, b - a)) for a, b in zip(edges[:-1], edges[1:])])

    return (cells.withColumn("block", F.pmod(F.xxhash64("cell"), F.lit(n_blocks)))
            .groupBy("block").applyInArrow(lambda t: block(t), out))


def _first_shared(t) -> np.ndarray:
    """Boolean matrix: pairs of the cell's rows that share no earlier bucket."""
    bucket = t.column("bucket")[0].as_py()
    lists = t.column("buckets").combine_chunks()
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    early = flat < bucket
    ids, inverse, count = np.unique(flat[early], return_inverse=True, return_counts=True)
    keep = count[inverse] > 1
    if not keep.any():
        return np.ones((len(lists), len(lists)), bool)
    cols = np.unique(inverse[keep], return_inverse=True)[1]
    m = np.zeros((len(lists), cols.max() + 1), np.float32)
    m[row[early][keep], cols] = 1
    return (m @ m.T) == 0


def _pairs_allowed(t) -> np.ndarray:
    """Pairs (left row, right row) that this cell decides."""
    node, left, right = (t.column(c).to_numpy(zero_copy_only=False) for c in ("node", "left", "right"))
    ok = left[:, None] & right[None, :] & _first_shared(t)
    both = (left & right)
    ok &= ~(both[:, None] & both[None, :]) | (node[:, None] < node[None, :])
    return ok & (node[:, None] != node[None, :])


def _candidates(threshold: float):
    """Members of a cell with a partner of enough agreeing tokens."""
    # a pair at the threshold agrees in fewer with a probability under 1e-11
    least = COORDS * threshold - 7.5 * np.sqrt(COORDS * threshold * (1 - threshold))

    def fn(t):
        x = np.frombuffer(b"".join(t.column("tokens").to_pylist()), np.uint32).reshape(-1, COORDS)
        agree = np.zeros((len(x), len(x)), np.uint8)
        for i in range(COORDS):
            agree += x[:, i][:, None] == x[:, i][None, :]
        m = (agree >= least) & _pairs_allowed(t)
        some = m.any(axis=0) | m.any(axis=1)
        import pyarrow as pa
        t = t.select(["cell", "bucket", "node", "left", "right", "buckets"]).filter(pa.array(some))
        return t.set_column(5, "buckets", t.column("buckets").cast(pa.list_(pa.int64())))

    return fn


def _shared_counts(sets: list) -> np.ndarray:
    """Sizes of all pairwise intersections, a few thousand shingles at a time."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[inverse] > 1
    row, col = row[keep], np.unique(inverse[keep], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    step = 2048
    for c in range(0, int(col[-1]) + 1 if len(col) else 0, step):
        a, b = np.searchsorted(col, [c, c + step])
        m = np.zeros((len(sets), step), np.float32)
        m[row[a:b], col[a:b] - c] = 1
        out += m @ m.T
    return out


def _verify(threshold: float):
    """Exact links of a cell: (node, links, to), see `near_duplicates`."""

    def fn(t):
        import pyarrow as pa
        node = t.column("node").to_numpy()
        _, once = np.unique(node, return_index=True)
        if len(once) < len(node):
            t = t.take(pa.array(once))
            node = node[once]
        n = t.column("n").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
        size = np.array([len(s) for s in sets], np.float64)
        shared = _shared_counts(sets).astype(np.float64)
        m = (shared / (size[:, None] + size[None, :] - shared) >= threshold) & _pairs_allowed(t)
        links = m @ n + m.T @ n
        some = links > 0
        edges = np.array(sorted(set(forest(m, node, node))), np.int64).reshape(-1, 2)
        return pa.table({
            "node": pa.array(np.concatenate([node[some], edges[:, 0]])),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(edges), np.int64)]),
                              mask=np.concatenate([np.zeros(some.sum(), bool), np.ones(len(edges), bool)])),
            "to": pa.array(np.concatenate([np.zeros(some.sum(), np.int64), edges[:, 1]]))})

    return fn


def _send_sets(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The cells' members with their whole shingle sets, read from one text of
    each class."""

    def emit(batches):
        import pyarrow as pa
        for b in batches:
            at = b.column("cells")
            for lo, sets in _sets(b.column("text"), k):
                rows = [(lo + i, c) for i in range(len(sets)) for c in at[lo + i].as_py()]
                if not rows:
                    continue
                take = pa.array([r for r, _ in rows])
                cells = pa.array([c for _, c in rows], at.type.value_type)
                yield pa.RecordBatch.from_arrays(
                    [*[cells.field(f) for f in ("cell", "bucket", "left", "right")], b.column("node").take(take),
                     b.column("n").take(take), b.column("buckets").take(take).cast(pa.list_(pa.int64())),
                     pa.array([sets[r - lo].tobytes() for r, _ in rows], pa.binary())],
                    ["cell", "bucket", "left", "right", "node", "n", "buckets", "set"])

    r = members.withColumnRenamed("id", "_id").withColumnRenamed("crc", "_crc")
    joined = docs.join(r, docs["id"].eqNullSafe(r["_id"]) & (docs["crc"] == r["_crc"])).select("text", "node", "n", "buckets", "cells")
    return joined.mapInArrow(emit, "cell long, bucket long, left boolean, right boolean, node long, n long, "
                                   "buckets array<long>, set binary")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), text_mark(text).alias("crc"), text.alias("text"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                    shingle: int = 5, runs: int = 10) -> DataFrame:
    """One row per row of ``docs``: (id, crc, class_id, n_links, component_id,
    has_shingles, component).

    ``class_id`` is the least id among the rows with the same shingle set,
    ``n_links`` counts the other rows of similarity >= ``threshold`` (copies
    included) and ``component_id`` is the least id reachable by links. Rows
    without shingles have their own id in both and no link. ``component`` tells
    components apart, also those whose least ids are equal or null; it is null
    without shingles.
    """
    texts = keyed_texts(docs, id_col, text_col)
    rows = written(_embed(texts, shingle), "shingle-rows")
    classes = written(
        rows.filter("key is not null").groupBy("key")
        .agg(F.count("*").alias("n"), F.min(F.struct("id", "crc")).alias("rep"), F.min("tokens").alias("tokens"))
        .select("key", "n", F.col("rep.id").alias("id"), F.col("rep.crc").alias("crc"), "tokens")
        .withColumn("node", F.monotonically_increasing_id()), "shingle-classes")
    buckets = _buckets(classes, runs)
    mine = buckets.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    sketches = classes.select("node", "tokens").join(mine, "node")
    cells = _cells(buckets).join(sketches, "node")
    n_rows = buckets.agg(F.sum(F.ceil(F.col("c") / F.lit(BLOCK)))).first()[0] or 0
    n_blocks = max(1, int(n_rows) // 2048)
    members = written(_compare(cells, n_blocks, _candidates(threshold),
                               "cell long, bucket long, node long, left boolean, right boolean, buckets array<long>"), "cell-members")
    wanted = (members.groupBy("node").agg(F.collect_list(F.struct("cell", "bucket", "left", "right")).alias("cells"),
                                          F.first("buckets").alias("buckets"))
              .join(classes.select("node", "n", "id", "crc"), "node"))
    found = written(_compare(_send_sets(texts, wanted, shingle), n_blocks, _verify(threshold), "node long, links long, to long"),
                    "shingle-links")
    counts = found.filter("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.filter("links is null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    labelled = (classes.select("key", "node", "n", "id").join(groups, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
    least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    labelled = (labelled.join(counts, "node", "left").join(least, "component")
                .select("key", F.col("id").alias("class_id"), "component_id", "component",
                        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (rows.select("id", "crc", "key").join(labelled, "key", "left")
            .select("id", "crc", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"), F.col("key").isNotNull().alias("has_shingles"),
                    "component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one of least
    (id, mark of the text); rows without shingles all stay."""
    found = written(near_duplicates(docs, id_col, text_col, **options), "shingle-groups")
    keep = (found.filter("has_shingles").groupBy("component").agg(F.min(F.struct("id", "crc")).alias("k"))
            .select(F.col("k.id").alias("_id"), F.col("k.crc").alias("_crc"), F.lit(True).alias("_one")))
    keep = keep.union(found.filter("not has_shingles").select("id", "crc").distinct().withColumn("_one", F.lit(False)))
    crc = text_mark(F.col(f"`{text_col}`"))
    kept = docs.withColumn("_crc_of", crc).join(
        keep, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (F.col("_crc_of") == F.col("_crc")))
    # equal rows of the chosen text are one; rows without shingles all stay
    kept = kept.withColumn("_row", F.when(~F.col("_one"), F.monotonically_increasing_id()))
    return kept.dropDuplicates(["_id", "_crc", "_row"]).select(*[F.col(f"`{c}`") for c in docs.columns])
