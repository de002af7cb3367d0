"""Near-duplicate embeddings by an exact metric range join.

Unit vectors with cosine >= t lie within distance r = sqrt(2 - 2 t). Pivots
split space into cells (a vector's home is its nearest pivot). By the triangle
inequality a vector x can have a partner in the cell of pivot q only if its
distance from the plane between its home pivot p and q is at most r:

    (cos(x, p) - cos(x, q)) / |p - q| <= r

so x is copied to exactly those cells. Each cell then compares its home vectors
with all vectors it holds, independently of the others, and every link of a
home vector is seen exactly there. Inside a cell, vectors are ordered by their
distance from the pivot, and only blocks whose distances differ by at most r
are multiplied. Cells larger than a block are dealt out as pairs of blocks.

Equal vectors are one class before the join. A cell returns, per home vector,
the number of links, and a forest that connects what is linked (never the
pairs), and the forest's components give the groups.

Defined results: vectors that are null, empty, zero or hold null or non-finite
numbers link with nothing; vectors of different lengths never link; every input
row is a vector of its own, also with a repeated id or equal numbers; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import components, forest, written

HOME_BLOCK, HELD_BLOCK, TILE = 8192, 32768, 1024


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column) -> np.ndarray:
    import pyarrow as pa
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _usable(vec):
    square = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & ~bad & (square > 0) & (square < float("inf")), F.lit(False))


def _pivots(classes: DataFrame, n: int, cell_size: int, max_pivots: int) -> np.ndarray:
    """Vectors spread by hash order; at most ``max_pivots`` come to the driver."""
    k = int(min(max_pivots, max(1, -(-n // cell_size))))
    rows = classes.orderBy(F.xxhash64("vec"), "node").limit(k).select("vec").collect()
    return _unit(np.array([list(r["vec"]) for r in rows], np.float64))


def _cells(x: np.ndarray, pivots: np.ndarray, gap: np.ndarray, r: float):
    """(home cell, boolean matrix of the other cells to be copied to)."""
    cos = x @ pivots.T
    home = cos.argmax(axis=1)
    lead = cos[np.arange(len(x)), home][:, None] - cos
    near = lead <= r * gap[home] + 1e-9
    near[np.arange(len(x)), home] = False
    return home, near


def _join_length(classes: DataFrame, n: int, threshold: float, cell_size: int, max_pivots: int) -> DataFrame:
    """Links among ``classes`` (node, n, vec), all of one length: (node, links,
    to): ``links`` a part of the node's count, or null where the row is a forest
    edge from node to ``to``."""
    r = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    pivots = _pivots(classes, n, cell_size, max_pivots)
    gap = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))

    def count(batches):
        import pyarrow as pa
        total = np.zeros((len(pivots), 2), np.int64)
        for b in batches:
            home, near = _cells(_unit(_matrix(b.column("vec"))), pivots, gap, r)
            total[:, 0] += np.bincount(home, minlength=len(pivots))
            total[:, 1] += near.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pivots))), pa.array(total[:, 0]), pa.array(total[:, 1])],
                                         ["cell", "home", "guests"])

    sizes = classes.select("vec").mapInArrow(count, "cell long, home long, guests long").groupBy("cell").agg(
        F.sum("home").alias("home"), F.sum("guests").alias("guests")).collect()
    subs, chunks = np.ones(len(pivots), np.int64), np.ones(len(pivots), np.int64)
    for s in sizes:
        subs[s["cell"]] = max(1, -(-s["home"] // HOME_BLOCK))
        chunks[s["cell"]] = max(1, -(-(s["home"] + s["guests"]) // HELD_BLOCK))

    def deal(batches):
        import pyarrow as pa
        for b in batches:
            vec = b.column("vec")
            home, near = _cells(_unit(_matrix(vec)), pivots, gap, r)
            node = b.column("node").to_numpy()
            for c in range(len(pivots)):
                own = np.flatnonzero(home == c)
                held = np.flatnonzero((home == c) | near[:, c])
                for rows, is_home in ((own, True), (held, False)):
                    if not len(rows):
                        continue
                    spread = node[rows] % (subs[c] if is_home else chunks[c])
                    for other in range(int(chunks[c] if is_home else subs[c])):
                        sub, chunk = (spread, np.full(len(rows), other)) if is_home else (np.full(len(rows), other), spread)
                        take = pa.array(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rows), c)), pa.array(sub), pa.array(chunk), pa.array(np.full(len(rows), is_home)),
                             b.column("node").take(take), b.column("n").take(take), vec.take(take)],
                            ["cell", "sub", "chunk", "home", "node", "n", "vec"])

    def compare(block):
        import pyarrow as pa
        home = block.column("home").to_numpy()
        raw, node, n = _matrix(block.column("vec")), block.column("node").to_numpy(), block.column("n").to_numpy()
        x = _unit(raw)
        centre = pivots[block.column("cell")[0].as_py()]
        away = np.sqrt(np.maximum(0, 2 - 2 * x @ centre))
        a, b = np.flatnonzero(home), np.flatnonzero(~home)
        a, b = a[np.argsort(away[a], kind="stable")], b[np.argsort(away[b], kind="stable")]
        links = np.zeros(len(a), np.int64)
        edges = set()
        for i in range(0, len(a), TILE):
            ai = a[i:i + TILE]
            lo = np.searchsorted(away[b], away[ai[0]] - r - 1e-9)
            hi = np.searchsorted(away[b], away[ai[-1]] + r + 1e-9, "right")
            for j in range(lo, hi, TILE):
                bj = b[j:min(j + TILE, hi)]
                m = _linked(x, raw, ai, bj, threshold) & (node[ai][:, None] != node[bj][None, :])
                if m.any():
                    links[i:i + TILE] += m @ n[bj]
                    edges.update(forest(m, node[ai], node[bj]))
        some = links > 0
        edges = np.array(sorted(edges), np.int64).reshape(-1, 2)
        yield_node = np.concatenate([node[a][some], edges[:, 0]])
        got = pa.array(np.concatenate([links[some], np.zeros(len(edges), np.int64)]),
                       mask=np.concatenate([np.zeros(some.sum(), bool), np.ones(len(edges), bool)]))
        to = pa.array(np.concatenate([np.zeros(some.sum(), np.int64), edges[:, 1]]))
        return pa.table({"node": pa.array(yield_node), "links": got, "to": to})

    kind = classes.schema["vec"].dataType.simpleString()
    return (classes.mapInArrow(deal, f"cell long, sub long, chunk long, home boolean, node long, n long, vec {kind}")
            .groupBy("cell", "sub", "chunk").applyInArrow(compare, "node long, links long, to long"))


def _linked(x, raw, ai, bj, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of at least the threshold. Pairs within
    rounding of it are decided by one dot product each."""
    s = x[ai] @ x[bj].T
    m = s >= threshold
    for p, q in np.argwhere(np.abs(s - threshold) < 1e-12):
        u, v = raw[ai[p]], raw[bj[q]]
        m[p, q] = (u @ v) / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= threshold
    return m


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                    cell_size: int = 4096, max_pivots: int = 256) -> DataFrame:
    """One row per vector: (id, n_links, component_id, kept)."""
    kind = "array<float>" if vectors.schema[vec_col].dataType.elementType.simpleString() == "float" else "array<double>"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast(kind).alias("vec"))
    good = rows.filter(_usable(F.col("vec")))
    classes = written(good.groupBy("vec").agg(F.count("*").alias("n"), F.min("id").alias("least"))
                      .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    lengths = classes.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).collect()
    parts = [_join_length(classes.filter(F.size("vec") == x["d"]).select("node", "n", "vec"), x["n"], threshold, cell_size, max_pivots)
             for x in lengths]
    found = None
    for p in parts:
        found = p if found is None else found.union(p)
    isolated = rows.filter(~_usable(F.col("vec"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if found is not None:
        found = written(found, "vector-links")
        counts = found.filter("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
        groups = components(found.filter("links is null").select(F.col("node").alias("a"), F.col("to").alias("b")))
        labelled = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
        labelled = (labelled.join(counts, "node", "left").join(least, "component")
                    .select("vec", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
        isolated = isolated.unionByName(good.join(labelled, "vec").select("id", "n_links", "component_id"))
    return isolated.select(F.col("id").alias(id_col), "n_links", "component_id",
                           F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
