"""Benchmark decontamination by latent semantic retrieval.

The benchmark's passages become TF-IDF vectors, with document frequencies
counted over the whole corpus, and a distributed randomised SVD (random
projection, power iterations, then a small eigenproblem) gives the latent space
they span; so do their rarest words in a second space. The texts' windows are
put into that one and searched by their cosine with every item; a window under
the item's floor is left out for it. The first gives the cosine of a match.

A stretch of a text, a quarter longer than the item, in a window that was found
is decided by the longest common subsequence of its words and the item's, and
for a paraphrase, where fewer words agree, also by the item's answer (a column,
or else the item's last words). The floor loses no stretch that could pass: one
with k of an item's n words in order holds at least j of the item's n - k + j
rarest words, whatever the corpus, and the floor is the least product that
these give a window with the item, less what the item has outside of the space
(`_search_space`). Of a window only places with that many are looked at.

Stretches are not shuffled and pairs are not emitted. The benchmark is handled in
blocks of at most ``block`` passages, so what a task holds is bounded whatever
the size of the benchmark; a block is a pass over the texts.

Defined results: words are runs of letters, digits and non-ASCII bytes, ASCII
lower case; null and empty texts match nothing; an item under ``MIN_WORDS``
words, which ordinary prose holds by chance, matches the texts whose words are
exactly the item's, one without words matches nothing; equal items and equal rows each get their matches; texts
are read whole; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import text_mark, written

MIN_WORDS = 5
PASSAGE, PASSAGE_STEP = 64, 32


def _word_lists(column):
    """For pieces of an Arrow text column: (first row, word hashes, words per row)."""
    from staylens.llm.words import ALNUM, pieces, text_buffer, word_bounds, word_hashes
    for lo, _, data, off in pieces(*text_buffer(column), 1 << 19):
        s, e, counts = word_bounds(data, off, ALNUM)
        yield lo, word_hashes(data, s, e, lower=True), counts


@dataclass
class Index:
    """A block of benchmark passages in its latent space."""

    terms: np.ndarray          # sorted word hashes
    idf: np.ndarray            # of the terms
    space: np.ndarray          # terms x rank, orthonormal columns
    item: np.ndarray           # passage -> item number
    latent: np.ndarray         # passages x rank, scaled so that a passage scores 1 with itself
    words: dict                # item number -> word hashes
    answers: dict              # item number -> answer word hashes
    numbers: np.ndarray        # place in the lists below -> item number
    size: np.ndarray           # words of a stretch
    least: np.ndarray          # how many of its rarest words a stretch must hold
    lists: np.ndarray          # places of the items that have a term among their rarest
    start: np.ndarray          # term -> first of its part of ``lists``; one more at the end
    short: dict = field(default_factory=dict)  # words of items under MIN_WORDS -> their item numbers
    search_space: np.ndarray | None = None     # terms x rank, of the items' rarest words
    latent_items: np.ndarray | None = None     # items x rank in that space
    floor: np.ndarray | None = None            # least product of a window that holds a match with the item's vector
    outside: np.ndarray | None = None          # length of the part of that vector outside of the space


def _terms(column_rows: DataFrame, name: str) -> DataFrame:
    """(item_id, words as hashes) of a bounded block of items."""

    def emit(batches):
        import pyarrow as pa
        for b in batches:
            for lo, words, counts in _word_lists(b.column(name)):
                off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("item_id").slice(lo, len(counts)),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(words.view(np.int64)))], ["item_id", "words"])

    kind = column_rows.schema["item_id"].dataType.simpleString()
    return column_rows.select("item_id", name).mapInArrow(emit, f"item_id {kind}, words array<long>")


def _document_frequencies(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, over all texts."""

    def count(batches):
        import pyarrow as pa
        total, n = np.zeros(len(terms), np.int64), 0
        for b in batches:
            for _, words, counts in _word_lists(b.column("text")):
                row = np.repeat(np.arange(len(counts)), counts)
                at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
                hit = terms[at] == words
                once = np.unique(row[hit] * len(terms) + at[hit]) % len(terms)
                total += np.bincount(once, minlength=len(terms))
                n += len(counts)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], n))], ["term", "n"])

    df = np.zeros(len(terms) + 1, np.int64)
    for r in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r["term"]] = r["n"]
    return df[:-1], int(df[-1])


def _vectors(passages: DataFrame, terms: np.ndarray, idf: np.ndarray) -> DataFrame:
    """TF-IDF rows (at, weight) of unit length of the passages (words)."""

    def emit(batches):
        import pyarrow as pa
        for b in batches:
            at, weight = [], []
            for words in b.column("words").to_pylist():
                t, c = np.unique(np.searchsorted(terms, np.array(words, np.int64).view(np.uint64)), return_counts=True)
                w = c * idf[t]
                at.append(t.astype(np.int32).tolist())
                weight.append((w / max(np.sqrt((w * w).sum()), 1e-12)).tolist())
            yield pa.RecordBatch.from_arrays([b.column("passage"), pa.array(at, pa.list_(pa.int32())), pa.array(weight, pa.list_(pa.float64()))],
                                             ["passage", "at", "weight"])

    return passages.mapInArrow(emit, "passage long, at array<int>, weight array<double>")


def _times(rows: DataFrame, m: np.ndarray) -> np.ndarray:
    """A' (A m) for the sparse row matrix A: each task sums its rows' outer
    products, the sums meet by ranges of terms."""
    width = m.shape[1]

    def partial(batches):
        import pyarrow as pa
        total = {}
        for b in batches:
            for at, weight in zip(b.column("at").to_pylist(), b.column("weight").to_pylist()):
                w = np.array(weight)
                y = w @ m[at]
                for t, x in zip(at, w):
                    total[t] = total.get(t, 0) + x * y
        if total:
            keys = sorted(total)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([total[k].tobytes() for k in keys], pa.binary())], ["term", "y"])

    def add(t):
        import pyarrow as pa
        total = {}
        for k, y in zip(t.column("term").to_pylist(), t.column("y").to_pylist()):
            total[k] = total.get(k, 0) + np.frombuffer(y)
        return pa.table({"term": pa.array(list(total), pa.int64()), "y": pa.array([v.tobytes() for v in total.values()], pa.binary())})

    out = np.zeros((len(m), width))
    for r in (rows.mapInArrow(partial, "term long, y binary").withColumn("part", F.col("term") % 16)
              .groupBy("part").applyInArrow(lambda t: add(t), "term long, y binary").collect()):
        out[r["term"]] = np.frombuffer(r["y"])
    return out


def _svd(rows: DataFrame, n_terms: int, rank: int, power: int = 2, seed: int = 3) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the distributed rows."""
    width = min(n_terms, rank + 8)
    q = np.random.default_rng(seed).normal(size=(n_terms, width))
    for _ in range(power + 1):
        q, _ = np.linalg.qr(_times(rows, q))
    small = q.T @ _times(rows, q)
    value, vector = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(value)[::-1][:rank]
    return q @ vector[:, top[value[top] > 1e-9]]


def stretch(n: int) -> int:
    """Words of a text among which an item of ``n`` words is looked for."""
    return n + n // 4 + 2


def _least(n: int, share: float) -> int:
    """The smallest count, at least 1, that is a ``share`` of ``n`` words."""
    return next(k for k in range(1, n + 2) if k / n >= share or k > n)


def _rarest(words: np.ndarray, terms: np.ndarray, df: np.ndarray, share: float) -> tuple[int, np.ndarray]:
    """(j, terms): a row of words that shares at least ``share`` of ``words``
    holds j or more words of ``terms``, which are the rarest of ``words``."""
    n = len(words)
    k = _least(n, share)
    j = max(1, k // 2)
    at = np.searchsorted(terms, words)
    return j, np.unique(at[np.argsort(df[at], kind="stable")][:n - k + j])


def _search_space(spark, words: list, terms: np.ndarray, df: np.ndarray, idf: np.ndarray, rank: int,
                  share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The latent space that the items' rarest words span, and for each item
    its vector there, the least product of a window that holds ``share`` of its
    words in order with its TF-IDF vector, and the length of what the space
    leaves out of that.

    Such a window holds j of the item's rarest words, each with a weight of at
    least idf / the length of the item in its unit vector; no weight is negative."""
    rare, floor = [], np.zeros(len(words))
    for i, w in enumerate(words):
        n, k, at = len(w), _least(len(w), share), np.searchsorted(terms, w)
        j, some = _rarest(w, terms, df, share)
        rare.append(w[np.isin(at, some)])
        t, c = np.unique(at[np.isin(at, some)], return_counts=True)
        least = np.sort(idf[at[np.argsort(df[at], kind="stable")][:n - k + j]] ** 2)[:j]
        floor[i] = least.sum() / np.sqrt(((c * idf[t]) ** 2).sum())
    table = written(spark.createDataFrame([(i, w.view(np.int64).tolist()) for i, w in enumerate(rare)], "passage long, words array<long>"), "rarest")
    vectors = written(_vectors(table, terms, idf), "rarest-vectors")
    space = _svd(vectors, len(terms), min(rank, len(words), len(terms)))
    latent = np.zeros((len(words), space.shape[1]))
    for r in vectors.collect():
        latent[r["passage"]] = np.array(r["weight"]) @ space[r["at"]]
    # the last part covers rounding: the products are of single floats
    outside = np.sqrt(np.maximum(1 - (latent ** 2).sum(axis=1), 0)) + 1e-4
    return space.astype(np.float32), latent.astype(np.float32), floor, outside


def build_index(docs: DataFrame, items: DataFrame, rank: int, answer_words: int, share: float) -> Index | None:
    """Index of one bounded block of items: (item_no, item_id, text[, answer])."""
    listed = {r["item_id"]: np.array(r["words"], np.int64).view(np.uint64) for r in
              _terms(items.select(F.col("item_no").alias("item_id"), "text"), "text").collect()}
    listed = {k: v for k, v in listed.items() if len(v)}
    if not listed:
        return None
    answers = {k: v[-answer_words:] for k, v in listed.items()}
    if "answer" in items.columns:
        given = _terms(items.select(F.col("item_no").alias("item_id"), F.col("answer")), "answer").collect()
        answers |= {r["item_id"]: np.array(r["words"], np.int64).view(np.uint64) for r in given if r["item_id"] in listed and r["words"]}
    short: dict = {}
    for k in [k for k, v in listed.items() if len(v) < MIN_WORDS]:
        short.setdefault(tuple(listed.pop(k).tolist()), []).append(k)
    if not listed:
        none = np.zeros(0, np.int64)
        return Index(none.view(np.uint64), none, none, none, none, {}, answers, none, none, none, none, np.zeros(1, np.int64), short)
    terms = np.unique(np.concatenate(list(listed.values())))
    df, n = _document_frequencies(docs, terms)
    idf = np.log((n + 1.0) / (df + 1.0)) + 0.1
    numbers = sorted(listed)
    passages = []
    for k in numbers:
        w = listed[k]
        for s in range(0, max(1, len(w) - PASSAGE + PASSAGE_STEP), PASSAGE_STEP):
            passages.append((k, w[s:s + PASSAGE]))
    spark = docs.sparkSession
    table = written(spark.createDataFrame([(i, w.view(np.int64).tolist()) for i, (_, w) in enumerate(passages)],
                                          "passage long, words array<long>"), "passages")
    vectors = written(_vectors(table, terms, idf), "passage-vectors")
    space = _svd(vectors, len(terms), min(rank, len(passages), len(terms)))
    latent = np.zeros((len(passages), space.shape[1]))
    for r in vectors.collect():
        latent[r["passage"]] = np.array(r["weight"]) @ space[r["at"]]
    size = np.sqrt((latent ** 2).sum(axis=1))
    keep = size > 1e-6
    rarest = [_rarest(listed[k], terms, df, share) for k in numbers]
    search = _search_space(spark, [listed[k] for k in numbers], terms, df, idf, rank, share)
    term = np.concatenate([t for _, t in rarest])
    place = np.repeat(np.arange(len(numbers)), [len(t) for _, t in rarest])
    return Index(terms, idf, space.astype(np.float32), np.array([k for k, _ in passages])[keep],
                 (latent[keep] / size[keep, None] ** 2).astype(np.float32), listed, answers, np.array(numbers),
                 np.array([stretch(len(listed[k])) for k in numbers]), np.array([j for j, _ in rarest]),
                 place[np.argsort(term, kind="stable")].astype(np.uint16 if len(numbers) < 1 << 16 else np.int64),
                 np.searchsorted(np.sort(term), np.arange(len(terms) + 1)), short, *search)


def _places(words: np.ndarray) -> dict:
    """Word -> bits of its places in ``words``."""
    out: dict = {}
    for i, x in enumerate(words.tolist()):
        out[x] = out.get(x, 0) | (1 << i)
    return out


def _in_order(places: dict, n: int, text: list) -> int:
    """Length of the longest common subsequence of ``text`` and the ``n`` words
    behind ``places``: a few operations on whole bit rows per word of text."""
    full = (1 << n) - 1
    v = full
    for x in text:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two rows of words."""
    return _in_order(_places(a), len(a), b.tolist())


class _Sought:
    """Windows of texts found by their cosine with an item in the latent space.

    The words of a row are dealt to cells as long as the longest stretch of
    items of about one length, and a window is a cell and the next, so it holds
    every stretch that starts in the cell. ``cells`` gives, by length class, the
    cell of each word and ``found`` the cells whose words may be of a stretch of
    an item."""

    PART = 1 << 13

    def __init__(self, index: Index, at: np.ndarray, known: np.ndarray, row: np.ndarray, first: np.ndarray):
        held = index.__dict__.setdefault("_sought", {})
        if not held:  # made once a task
            held["weighted"] = index.search_space * index.idf[:, None].astype(np.float32)
            held["kind"] = np.frexp(index.size.astype(np.float64))[1] // 2
        self.kind = held["kind"]
        pos = np.flatnonzero(known)
        pos = pos[np.diff(index.start)[at[pos]] > 0]  # other words have no part in the space
        self.cells, self.found = {}, {}
        for kind in np.unique(self.kind).tolist() if len(pos) else ():
            mine = self.kind == kind
            span = int(index.size[mine].max())
            cell = (pos - first[row[pos]]) // span
            new = np.append(True, (np.diff(row[pos]) != 0) | (np.diff(cell) != 0))
            start = np.flatnonzero(new)
            follows = np.flatnonzero((np.diff(row[pos[start]]) == 0) & (np.diff(cell[start]) == 1))
            window = self._sums(held["weighted"], at[pos], start)
            # at least as long as the window's vector
            length = np.add.reduceat(index.idf[at[pos]], start)
            window[follows], length[follows] = window[follows] + window[follows + 1], length[follows] + length[follows + 1]
            hit = window @ index.latent_items.T >= index.floor - length[:, None] * index.outside
            hit &= mine
            both = hit.copy()
            both[follows + 1] |= hit[follows]
            self.cells[kind], self.found[kind] = np.full(len(known), -1), both
            self.cells[kind][pos] = np.cumsum(new) - 1

    def _sums(self, weighted: np.ndarray, term: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The cells' vectors, some words at a time."""
        out, end, a = np.empty((len(start), weighted.shape[1]), np.float32), np.append(start, len(term)), 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(end, end[a] + self.PART, "right")) - 1)
            out[a:b] = np.add.reduceat(weighted[term[end[a]:end[b]]], start[a:b] - end[a])
            a = b
        return out

    def of(self, pos: np.ndarray) -> np.ndarray:
        """Whether a word is in a window that was found for any item."""
        out = np.zeros(len(pos), bool)
        for kind, found in self.found.items():
            out |= found.any(axis=1)[self.cells[kind][pos]]
        return out

    def pairs(self, pos: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether a word is in a window that was found for the item."""
        out = np.zeros(len(pos), bool)
        for kind, found in self.found.items():
            some = np.flatnonzero(self.kind[item] == kind)
            out[some] = found[self.cells[kind][pos[some]], item[some]]
        return out


def _hits(index: Index, at: np.ndarray, known: np.ndarray, row: np.ndarray, sought: _Sought | None = None):
    """Places from which a stretch holds enough of an item's rarest words:
    (row, item number, first words of such places), a part of the words at a
    time, so that a pair may come again with later places. With ``sought`` only
    words of an item's windows are looked at."""
    listed = np.diff(index.start)
    pos = np.flatnonzero(known)
    pos = pos[listed[at[pos]] > 0]
    if sought is not None:
        pos = pos[sought.of(pos)]
    step, apart = 1 << 16, int(index.size.max())
    for lo in range(0, len(pos), step):
        upto = pos[min(lo + step, len(pos)) - 1]
        p = pos[lo:np.searchsorted(pos, upto + apart)]
        n = listed[at[p]]
        first = np.cumsum(n) - n
        item = index.lists[np.arange(n.sum()) + np.repeat(index.start[at[p]] - first, n)]
        p = np.repeat(p, n)
        if sought is not None:
            found = sought.pairs(p, item)
            p, item = p[found], item[found]
        order = np.argsort(item, kind="stable")
        item = item[order].astype(np.int64)
        p = p[order]
        last = np.arange(len(p)) + index.least[item] - 1
        ok = (p <= upto) & (last < len(p))
        last = np.minimum(last, len(p) - 1)
        hit = np.flatnonzero(ok & (item[last] == item) & (row[p[last]] == row[p]) & (p[last] - p < index.size[item]))
        if not len(hit):
            continue
        p, item = p[hit], item[hit]
        new = np.flatnonzero((np.diff(row[p]) != 0) | (np.diff(item) != 0)) + 1
        for a, b in zip([0, *new], [*new, len(p)]):
            yield int(row[p[a]]), int(index.numbers[item[a]]), p[a:b]


def _prepared(index: Index, item: int):
    """An item's places, those of its answer, and their words with whether the
    item has them; made once a task."""
    held = index.__dict__.setdefault("_held", {})
    if item not in held:
        want, wanted = index.words[item], index.answers[item]
        known = np.unique(np.concatenate([want, wanted]))
        held[item] = _places(want), _places(wanted), known, np.isin(known, want)
    return held[item]


def _judge(index: Index, words: np.ndarray, hits: np.ndarray, item: int, exact: float, loose: float,
           answer: float) -> tuple[bool, float, float, int]:
    """Of all stretches of ``words`` that hold one of the places ``hits``, the
    best: whether it matches, the share of the item's words found in order, the
    share of its answer there, and where it starts.

    Words that neither the item nor its answer has change nothing, so only the
    others are looked at, a stretch starts at one of them, and one with fewer of
    the item's words than the limits ask for is passed over.
    """
    wanted = index.answers[item]
    n = len(index.words[item])
    size, floor, best = stretch(n), min(exact, loose), (False, 0.0, 0.0, -1)
    places, replies, known, mine = _prepared(index, item)
    for near in np.split(hits, np.flatnonzero(np.diff(hits) >= 2 * size) + 1):
        lo = max(int(near[0]) - size + 1, 0)
        part = words[lo:int(near[-1]) + size]
        at = np.minimum(np.searchsorted(known, part), len(known) - 1)
        shared = np.flatnonzero(known[at] == part)
        text, of_item = part[shared].tolist(), np.concatenate([[0], np.cumsum(mine[at[shared]])])
        end = np.searchsorted(shared, shared + size)
        ends, seen, upto = end.tolist(), -1, 0
        for a in np.flatnonzero((of_item[end] - of_item[:-1]) / n >= floor).tolist():
            # a later stretch has at most its new words more in order than an earlier one
            if seen >= 0 and (seen + ends[a] - upto) / n < (best[1] if best[0] else floor):
                continue
            some = text[a:ends[a]]
            seen, upto = _in_order(places, n, some), ends[a]
            got = seen / n
            if got < floor:
                continue
            ans = _in_order(replies, len(wanted), some) / len(wanted)
            found = (got >= exact or (got >= loose and ans >= answer), got, ans)
            if found > best[:3]:
                best = (*found, lo + int(shared[a]))
    return best


def _cosine(index: Index, at: np.ndarray, item: int) -> float:
    """Best cosine of a stretch (its benchmark terms) with the item's passages."""
    of_item = index.item == item
    if not len(at) or not of_item.any():
        return 0.0
    term, n = np.unique(at, return_counts=True)
    weight = n * index.idf[term]
    return float((index.latent[of_item] @ (weight @ index.space[term])).max() / np.sqrt((weight ** 2).sum()))


def search(docs: DataFrame, index: Index, exact: float, loose: float, answer: float) -> DataFrame:
    """Matches of one block: (id, crc, item_no, cosine, lcs, answer, first_word):
    the stretches that pass of the windows found in the latent space."""

    def find(batches):
        import pyarrow as pa
        for b in batches:
            rows = []
            for lo, words, counts in _word_lists(b.column("text")):
                first = np.cumsum(counts) - counts
                if index.short:
                    for row in np.flatnonzero((counts > 0) & (counts < MIN_WORDS)).tolist():
                        text = words[first[row]:first[row] + counts[row]]
                        for item in index.short.get(tuple(text.tolist()), ()):
                            wanted = index.answers[item]
                            rows.append((lo + row, item, 1.0, 1.0, common_subsequence(wanted, text) / len(wanted), 0))
                if not len(index.terms):
                    continue
                at = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
                known = index.terms[at] == words
                found: dict = {}
                rows_of = np.repeat(np.arange(len(counts)), counts)
                for row, item, hits in _hits(index, at, known, rows_of, _Sought(index, at, known, rows_of, first)):
                    found.setdefault((row, item), []).append(hits)
                for (row, item), hits in found.items():
                    f, e = first[row], first[row] + counts[row]
                    match, got, ans, where = _judge(index, words[f:e], np.concatenate(hits) - f, item, exact, loose, answer)
                    if match:
                        here = slice(f + where, min(f + where + stretch(len(index.words[item])), e))
                        rows.append((lo + row, item, _cosine(index, at[here][known[here]], item), got, ans, where))
            if rows:
                cols = list(zip(*rows))
                take = pa.array(cols[0])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(take), b.column("crc").take(take), pa.array(cols[1], pa.int64()), pa.array(cols[2]), pa.array(cols[3]),
                     pa.array(cols[4]), pa.array(cols[5], pa.int64())], ["id", "crc", "item_no", "cosine", "lcs", "answer", "first_word"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(find, f"id {kind}, crc binary, item_no long, cosine double, lcs double, answer double, first_word long")


def _crc(text_col: str):
    return text_mark(F.col(f"`{text_col}`"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank: int = 256,
                 block: int = 256, exact: float = 0.7, loose: float = 0.5, answer: float = 0.8,
                 answer_words: int = 5) -> DataFrame | None:
    """Matches (id, crc, item_id, cosine, lcs, answer, first_word) of texts with
    items of ``benchmark`` (item_id, text[, answer]); crc is the text's `text_mark`.

    A stretch of `stretch` words matches if a share ``exact`` of the item's
    words follow one another in it, or a share ``loose`` together with a share
    ``answer`` of the item's answer. A text's best stretch is returned.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), _crc(text_col).alias("crc"), F.col(f"`{text_col}`").alias("text"))
    items = written(benchmark.select("item_id", "text", *(["answer"] if "answer" in benchmark.columns else []))
                    .withColumn("item_no", F.monotonically_increasing_id()), "items")
    n_items = items.count()
    n_blocks = max(1, -(-n_items // block))
    part = F.pmod(F.xxhash64("item_no"), F.lit(n_blocks))
    out = None
    for k in range(n_blocks):
        index = build_index(texts, items.filter(part == k), rank, answer_words, min(exact, loose))
        if index is None:
            continue
        got = search(texts, index, exact, loose, answer)
        out = got if out is None else out.union(got)
    if out is None:
        out = texts.filter("false").select("id", "crc", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("item_no", "long"), ("cosine", "double"), ("lcs", "double"), ("answer", "double"), ("first_word", "long"))])
    return out.join(items.select("item_no", "item_id"), "item_no").drop("item_no")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the texts that match an item. Rows are told apart by
    (id, mark of the text)."""
    found = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col("id").alias("_id"), F.col("crc").alias("_crc")).distinct()
    return docs.join(found, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (_crc(text_col) == F.col("_crc")), "left_anti")
