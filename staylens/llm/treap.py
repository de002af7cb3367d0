"""Ranked lexical search with a k2-treap over the grid of terms and documents.

The documents of an input partition are dealt into shards of bounded size. A
shard is a grid with a row a term and a column a document (by ascending id),
whose points are impacts: what a document adds to a query's score per unit of
the term's weight. The grid is cut into square tiles, and each tile is a
compressed quadtree: every cell stores the largest impact below it, as the
difference to its parent's, and a cell with a single point stores the point.

A query follows the paths of its terms' rows through their tiles jointly: a
range of documents carries, for each term, the cell of that range, so the sum
of weight * maximum bounds every score in the range. Ranges are halved best
bound first, many at a time, until none can beat the k-th best document found,
ties by id included. Nothing is sampled or cut off, so results are exact.

Score of a document: sum over the query's terms, once each, of
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 10 + (90 * n * N) div L``.
Terms are told apart by 64-bit hashes of their bytes.

Defined results: a null or empty text holds no term; rows with one document id
are documents of their own, a null id is ordered last; rows with one item id
(null included) are one query with all their terms; a query without a term
that occurs has no row, nor has any query on an empty table. Only the columns
named are read, so further ones may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staylens.llm.common import LARGE_ROWS, written
from staylens.llm.words import ALNUM, pieces, text_buffer, word_bounds, word_hashes
from staylens.session import small_batches

#: A shard is closed at so many terms (with repeats); one longer text has a shard of its own.
SHARD_TERMS = 1_000_000
#: Distinct (query, term) pairs that are held at a time by the driver and a task: 16 bytes each.
BLOCK_TERMS = 2_000_000
#: Queries whose ranges of documents are held at a time.
TOGETHER = 16
_ONES = np.array([bin(i).count("1") for i in range(16)], np.uint8)


# --- terms -----------------------------------------------------------------


def terms(column) -> tuple[np.ndarray, np.ndarray]:
    """(term hashes, terms per row) of a text column; A-Z are lower-cased."""
    hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, data, off in pieces(*text_buffer(column)):
        starts, ends, n = word_bounds(data, off, ALNUM)
        hashes.append(word_hashes(data, starts, ends, lower=True))
        sizes.append(n)
    return np.concatenate(hashes), np.concatenate(sizes)


def totals(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all their terms) of ``docs`` (text)."""

    def count(batches):
        n = total = 0
        for batch in batches:
            sizes = terms_per_row(batch["text"])
            n, total = n + int((sizes > 0).sum()), total + int(sizes.sum())
        yield pa.RecordBatch.from_pydict({"n": [n], "total": [total]})

    row = docs.select("text").mapInArrow(count, "n long, total long").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return row["n"] or 0, row["total"] or 0


def terms_per_row(column) -> np.ndarray:
    sizes = [word_bounds(data, off, ALNUM)[2] for _, _, data, off in pieces(*text_buffer(column))]
    return np.concatenate(sizes) if sizes else np.zeros(0, np.int64)


# --- one shard's treap -----------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of x at the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _gather(x: np.ndarray) -> np.ndarray:
    """The bits at even places of x; undoes `_spread`."""
    x = x.astype(np.uint64) & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> np.uint64(shift))) & np.uint64(mask)
    return x.astype(np.int64)


def build(rows: np.ndarray, cols: np.ndarray, impact: np.ndarray, n_cols: int) -> dict:
    """Treap of distinct points (row, col, impact): cells level by level, the
    children of a level in the order of their parents.

    ``mask`` has a bit for each child of a cell (0: a single point), ``drop``
    the parent's maximum less the cell's (the maximum itself at a root), and
    ``points`` the place in its tile of each single point, in cell order."""
    high = max(1, int(n_cols - 1).bit_length())
    side = (1 << high) - 1
    code = (rows.astype(np.uint64) >> np.uint64(high) << np.uint64(2 * high)) | (_spread(rows & side) << np.uint64(1)) | _spread(cols)
    order = np.argsort(code, kind="stable")
    code, value = code[order], impact[order].astype(np.int64)
    masks, drops, points = [], [], []
    above = None  # maximum of the parent, for every point that is left
    for level in range(high + 1):
        cell = code >> np.uint64(2 * (high - level))
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        if not len(first):
            break
        size = np.diff(np.append(first, len(cell)))
        top = np.maximum.reduceat(value, first)
        drops.append(top if above is None else above[first] - top)
        single = size == 1
        points.append(code[first[single]] & np.uint64((1 << 2 * high) - 1))
        left = np.repeat(~single, size)
        code, value, above = code[left], value[left], np.repeat(top, size)[left]
        mask = np.zeros(len(first), np.uint8)
        if len(code):
            child = code >> np.uint64(2 * (high - level - 1))
            start = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]]))
            parent = child[start] >> np.uint64(2)
            heads = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            mask[~single] = np.bitwise_or.reduceat(np.uint8(1) << (child[start] & np.uint64(3)).astype(np.uint8), heads)
        masks.append(mask)
    join = lambda parts, kind: np.concatenate(parts or [np.zeros(0)]).astype(kind)
    return {"high": high, "roots": len(masks[0]) if masks else 0, "mask": join(masks, np.uint8), "drop": join(drops, np.uint32), "points": join(points, np.uint32)}


class Treap:
    """A treap as read back: ``top`` (maximum), ``child`` (first child), ``mask``
    and, for single points, ``row`` and ``col`` inside the tile, by cell."""

    def __init__(self, high: int, roots: int, mask: np.ndarray, drop: np.ndarray, points: np.ndarray):
        self.high, self.mask = high, mask
        ones = _ONES[mask].astype(np.int64)
        self.child = roots + np.cumsum(ones) - ones
        self.top = drop.astype(np.int64)
        lo, hi = 0, roots
        while hi < len(mask):  # the children of the cells lo..hi follow them
            n = int(ones[lo:hi].sum())
            self.top[hi:hi + n] = np.repeat(self.top[lo:hi], ones[lo:hi]) - self.top[hi:hi + n]
            lo, hi = hi, hi + n
        single = mask == 0
        self.row, self.col = np.zeros(len(mask), np.int32), np.zeros(len(mask), np.int32)
        self.row[single], self.col[single] = _gather(points >> 1), _gather(points)

    def children(self, cell, row, level, bit):
        """The cells below ``cell`` on the path of ``row`` in the half ``bit``
        of the columns, and where there is one."""
        shift = self.high - 1 - level
        mask = self.mask[cell]
        single = mask == 0
        quarter = (2 * ((row >> shift) & 1) + bit).astype(np.uint8)
        here = np.where(single, (self.col[cell] >> shift) & 1 == bit, (mask >> quarter) & 1 == 1)
        below = np.where(single, cell, self.child[cell] + _ONES[mask & ((np.uint8(1) << quarter) - np.uint8(1))])
        at = below[here]
        here[here] = (self.mask[at] != 0) | (self.row[at] == row[here])
        return below, here

    def search(self, query: np.ndarray, row: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, column, score) of the best ``k`` columns with a score above 0
        of every query, given as its terms' rows and weights (sorted by query).

        The frontier are ranges of columns of all queries. Each round halves
        every query's best ranges; a range goes when its bound, or at equal
        bounds its first column, cannot beat the query's k-th result."""
        asked, query = np.unique(query, return_inverse=True)
        ranges = _Ranges.start(self, query, row, weight)
        n_queries = len(asked)
        best = np.zeros((3, 0), np.int64)  # query, -score, column
        floor = np.zeros(n_queries, np.int64)
        last = np.full(n_queries, -1, np.int64)
        width, rounds = 16, 0
        while len(ranges):
            order = np.lexsort((ranges.first, -ranges.bound, ranges.query))
            q = ranges.query[order]
            start = np.concatenate([[True], q[1:] != q[:-1]])
            place = np.arange(len(q)) - np.maximum.accumulate(np.where(start, np.arange(len(q)), 0))
            chosen = np.zeros(len(q), bool)
            chosen[order[place < width]] = True
            halves = ranges.take(chosen).halve(self)
            whole = halves.level == self.high
            if whole.any():
                best = np.concatenate([best, np.stack([halves.query[whole], -halves.bound[whole], halves.first[whole]])], axis=1)
                best = best[:, np.lexsort(best[::-1])]
                start = np.searchsorted(best[0], np.arange(n_queries))
                best = best[:, np.arange(best.shape[1]) - start[best[0]] < k]
                start = np.searchsorted(best[0], np.arange(n_queries))
                full = np.flatnonzero(np.diff(np.append(start, best.shape[1])) == k)
                floor[full], last[full] = -best[1, start[full] + k - 1], best[2, start[full] + k - 1]
            ranges = _Ranges.join(ranges.take(~chosen), halves.take(~whole))
            limit = floor[ranges.query]
            ranges = ranges.take((ranges.bound > limit) | ((ranges.bound == limit) & (ranges.first < last[ranges.query])))
            rounds += 1
            if rounds > self.high:
                width *= 2
        return asked[best[0]], best[2], -best[1]


class _Ranges:
    """Ranges of columns (query, first column, level, bound) and, in the same
    order, the (cell, row, weight) of each term that may occur in them."""

    def __init__(self, query, first, level, bound, size, cell, row, weight):
        self.query, self.first, self.level, self.bound, self.size = query, first, level, bound, size
        self.cell, self.row, self.weight = cell, row, weight

    def __len__(self):
        return len(self.query)

    @classmethod
    def start(cls, treap, query, row, weight):
        cell, own = row >> treap.high, row & ((1 << treap.high) - 1)
        real = (weight > 0) & ((treap.mask[cell] != 0) | (treap.row[cell] == own))
        return cls._summed(treap, query[real], np.zeros(real.sum(), np.int64), np.zeros(real.sum(), np.int64), cell[real], own[real], weight[real], query[real])

    @classmethod
    def _summed(cls, treap, query, first, level, cell, row, weight, key):
        """Ranges of pairs that stand together by ``key``."""
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        bound = np.add.reduceat(weight * treap.top[cell], head) if len(head) else np.zeros(0, np.int64)
        return cls(query[head], first[head], level[head], bound, np.diff(np.append(head, len(key))), cell, row, weight)

    @classmethod
    def join(cls, a, b):
        return cls(*[np.concatenate(x) for x in zip(a._parts(), b._parts())])

    def _parts(self):
        return self.query, self.first, self.level, self.bound, self.size, self.cell, self.row, self.weight

    def take(self, which):
        pairs = np.repeat(which, self.size)
        return _Ranges(*[x[which] for x in self._parts()[:5]], *[x[pairs] for x in self._parts()[5:]])

    def halve(self, treap):
        of = np.repeat(np.arange(len(self)), self.size)
        level = self.level[of]
        halves = []
        for bit in (0, 1):
            cell, here = treap.children(self.cell, self.row, level, bit)
            at = of[here]
            first = self.first[at] + (bit << (treap.high - 1 - self.level[at]))
            halves.append(_Ranges._summed(treap, self.query[at], first, self.level[at] + 1, cell[here], self.row[here], self.weight[here], at))
        return _Ranges.join(*halves)


# --- the index -------------------------------------------------------------

_PARTS = ("terms", "df", "mask", "drop", "points")


def index(docs: DataFrame, n_docs: int, n_terms: int, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Written table of shards, one row each: the ids of its documents with a
    term in ascending order (null last), the terms' hashes by falling count, in
    how many documents each is, and the treap. ``docs`` is (doc_id, text),
    ``n_docs`` and ``n_terms`` are its `totals`. Every document is in one shard;
    nothing is exchanged. A shard is a row of some 9 MB and a row group of its
    own, so however many a task makes or reads, it holds one at a time."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def shard(ids, hashes, sizes):
        order = pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        distinct, term = np.unique(np.concatenate(hashes), return_inverse=True)
        hashes.clear()
        term *= len(order)
        term += np.repeat(place, sizes)
        term.sort()
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        tf = np.diff(np.append(first, len(term)))
        term, col = np.divmod(term[first], len(order))
        df = np.bincount(term, minlength=len(distinct))
        by_count = np.argsort(-df, kind="stable")
        row = np.empty(len(distinct), np.int64)
        row[by_count] = np.arange(len(distinct))
        m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in sizes[order]], np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[col])
        made = build(row[term], col, impact, len(order))
        return {"ids": ids.take(pa.array(order)), "high": made["high"], "roots": made["roots"], "terms": distinct[by_count], "df": df[by_count].astype(np.uint32),
                **{p: made[p] for p in ("mask", "drop", "points")}}

    def emit(ids, hashes, sizes):
        made = shard(pa.concat_arrays(ids), hashes, np.concatenate(sizes))
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(made["ids"])], pa.int32()), made["ids"]), pa.array([made["high"]], pa.int32()), pa.array([made["roots"]], pa.int32()),
             *[pa.array([made[p].tobytes()], pa.binary()) for p in _PARTS]], ["ids", "high", "roots", *_PARTS])

    def deal(batches):
        ids, hashes, sizes, held = [], [], [], 0
        for batch in batches:
            h, n = terms(batch["text"])
            keep = np.flatnonzero(n > 0)
            upto = np.concatenate([[0], np.cumsum(n)])
            lo = 0
            while lo < len(keep):
                end = int(np.searchsorted(upto[keep + 1], upto[keep[lo]] + max(shard_terms - held, 1), "right"))
                end = max(end, lo + (not held))
                if end > lo:
                    rows = keep[lo:end]
                    ids.append(batch["doc_id"].take(pa.array(rows)))
                    hashes.append(h[upto[rows[0]]:upto[rows[-1] + 1]])
                    sizes.append(n[rows])
                    held += len(hashes[-1])
                    lo = end
                if lo < len(keep) or held >= shard_terms:
                    yield emit(ids, hashes, sizes)
                    ids, hashes, sizes, held = [], [], [], 0
        if held:
            yield emit(ids, hashes, sizes)

    import pyarrow.compute  # noqa: F401
    schema = f"ids array<{kind}>, high int, roots int, " + ", ".join(f"{p} binary" for p in _PARTS)
    return written(docs.select("doc_id", "text").mapInArrow(deal, schema), "treap", LARGE_ROWS)


# --- queries ---------------------------------------------------------------


def query_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of ``items`` (item_id, text)."""

    def emit(batches):
        for batch in batches:
            h, n = terms(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["item_id"].take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(h.view(np.int64))], ["item_id", "term"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(emit, f"item_id {kind}, term long").distinct()


def document_counts(shards: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(term, df) of the sorted hashes ``wanted`` that occur: sums of the counts
    that each shard holds."""
    known = shards.sparkSession.sparkContext.broadcast(wanted)

    def emit(batches):
        found = np.zeros(len(known.value), np.int64)
        for batch in batches:
            for own, df in zip(batch["terms"], batch["df"]):
                own = np.frombuffer(own.as_buffer(), np.uint64)
                at = np.searchsorted(known.value, own)
                hit = (at < len(known.value)) & (known.value[np.minimum(at, len(known.value) - 1)] == own)
                found[at[hit]] += np.frombuffer(df.as_buffer(), np.uint32)[hit]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"term": known.value[some].view(np.int64), "df": found[some]})

    return shards.select("terms", "df").mapInArrow(emit, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _blocks(found: DataFrame, limit: int):
    """Frames of whole queries with at most ``limit`` (item_id, term) pairs, or
    one query. The queries are dealt by hash; blocks that come out too large
    are dealt again."""
    todo = [(found, 0)]
    while todo:
        frame, salt = todo.pop()
        size = frame.agg(F.count("*").alias("n"), F.count_distinct(F.struct("item_id")).alias("items")).first()
        if size["n"] <= limit or size["items"] == 1:
            if size["n"]:
                yield frame
            continue
        parts = math.ceil(2 * size["n"] / limit)
        todo += [(frame.filter(F.pmod(F.xxhash64("item_id", F.lit(salt)), F.lit(parts)) == i), salt + 1) for i in range(parts)]


def search(docs: DataFrame, items: DataFrame, k: int = 10, shard_terms: int = SHARD_TERMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of
    ``docs`` (doc_id, text) with a score above 0 for each item of ``items``
    (item_id, text), equal scores by ascending id.

    The index is built and written once. A block of queries (bounded by
    ``block_terms``, else one query) goes to every shard, whose best k documents
    are merged. All that goes through Python is done when this returns."""
    with small_batches(docs.sparkSession):
        return _search(docs, items, k, shard_terms, block_terms)


def _search(docs: DataFrame, items: DataFrame, k: int, shard_terms: int, block_terms: int) -> DataFrame:
    n_docs, n_terms = totals(docs)
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    if not n_docs:
        return docs.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    shards = index(docs, n_docs, n_terms, shard_terms)
    found = written(query_terms(items), "query-terms")
    hits = None
    for block in _blocks(found, block_terms):
        part = written(_search_block(shards, block, n_docs, k, kind, item_kind), "hits")
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return docs.sparkSession.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_block(shards: DataFrame, block: DataFrame, n_docs: int, k: int, kind: str, item_kind: str) -> DataFrame:
    """The best k documents of every shard for each item of a bounded block."""
    pairs = block.orderBy("item_id").toArrow()
    items = pairs["item_id"].combine_chunks()
    term = pairs["term"].to_numpy().view(np.uint64)
    counted = document_counts(shards, np.unique(term))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    weights = counted.select("term", weight.alias("w")).toArrow()
    by_term = np.argsort(known := weights["term"].to_numpy().view(np.uint64))
    known, w = known[by_term], weights["w"].to_numpy()[by_term]
    at = np.searchsorted(known, term)
    hit = np.flatnonzero((at < len(known)) & (known[np.minimum(at, max(len(known) - 1, 0))] == term)) if len(known) else np.zeros(0, np.int64)
    codes = items.dictionary_encode(null_encoding="encode")
    held = block.sparkSession.sparkContext.broadcast((codes.dictionary, codes.indices.to_numpy()[hit].astype(np.int64), term[hit], w[at[hit]]))

    def find(batches):
        names, query, wanted, weight = held.value
        by_query = np.argsort(query, kind="stable")
        query, wanted, weight = query[by_query], wanted[by_query], weight[by_query]
        cuts = np.searchsorted(query, np.arange(0, len(names) + TOGETHER, TOGETHER))
        runs = list(zip(cuts, cuts[1:]))
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {p: np.frombuffer(batch[p][i].as_buffer(), t) for p, t in (("terms", np.uint64), ("mask", np.uint8), ("drop", np.uint32), ("points", np.uint32))}
                order = np.argsort(raw["terms"])
                at = np.minimum(np.searchsorted(raw["terms"], wanted, sorter=order), len(order) - 1)
                row = order[at]
                own = raw["terms"][row] == wanted
                treap = Treap(batch["high"][i].as_py(), batch["roots"][i].as_py(), raw["mask"], raw["drop"], raw["points"])
                q, col, score = (np.concatenate(x) for x in zip(*[treap.search(query[a:b][own[a:b]], row[a:b][own[a:b]], weight[a:b][own[a:b]], k) for a, b in runs]))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(q)), batch["ids"][i].values.take(pa.array(col)), pa.array(score, pa.int64())],
                                                 ["item_id", "doc_id", "score"])

    return shards.drop("df").mapInArrow(find, f"item_id {item_kind}, doc_id {kind}, score long")
