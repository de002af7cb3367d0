"""Operators on whole texts, against brute force and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylens.llm import decontaminate, jaccard, katz, langid, licenses, mixing, ngrams, substrings, toxicity, words

from llm_data import SCHEMA, clashing, prose


# --- words --------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\nÄéZ9.", max_size=30)), max_size=12), st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, limit):
    data, off = words.text_buffer(pa.array(texts, pa.string()))
    got, by_hash = [], {}
    for lo, hi, d, o in words.pieces(data, off, limit):
        s, e, n = words.word_bounds(d, o)
        for h, a, b in zip(words.word_hashes(d, s, e), s, e):
            assert by_hash.setdefault(int(h), bytes(d[a:b])) == bytes(d[a:b])
        got += n.tolist()
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_hashes_do_not_depend_on_the_cut():
    long = ("w" * 700 + " ") * 900
    data, off = words.text_buffer(pa.array([long]))
    s, e, _ = words.word_bounds(data, off)
    assert len(set(words.word_hashes(data, s, e).tolist())) == 1
    h = np.arange(600_000, dtype=np.uint64) % np.uint64(7)
    w = words.window_hashes(words.mix(h), 35)
    assert len(w) == len(h) - 34 and len(np.unique(w)) == 7


# --- mixing -------------------------------------------------------------------
def _brute_targets(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    left, budget, out = {s: weights[i % 3] for i, s in enumerate(names)}, share * sum(sizes.values()), {}
    while left:
        rate = budget / sum(left.values())
        over = [s for s in left if repeats * sizes[s] < rate * left[s]]
        if not over:
            return out | {s: rate * w for s, w in left.items()}
        for s in over:
            out[s] = float(repeats * sizes[s])
            budget -= out[s]
            del left[s]
    return out


def test_mix_meets_its_targets(messy):
    sized = messy.withColumn("n", mixing.word_count("text"))
    got = mixing.mix(sized, size_col="n", range_rows=7).collect()
    assert len(got) == messy.count()
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r["n"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["n"]
        taken[r["source"]] += r["n"] * r["copies"]
    targets = _brute_targets(sizes)
    largest = max(r["n"] for r in got)
    for r in got:
        assert r["target"] == pytest.approx(targets[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert abs(taken[r["source"]] - r["target"]) <= largest
        assert r["n"] or not r["copies"]
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_mix_agrees_with_itself_and_with_other_ranges(messy):
    sized = messy.withColumn("n", mixing.word_count("text"))
    runs = [sorted((str(r["doc_id"]), r["n"], r["copies"]) for r in mixing.mix(sized.repartition(k), size_col="n", range_rows=m).collect())
            for k, m in ((1, 10_000), (5, 3))]
    assert runs[0] == runs[1]


def test_mixture_of_nothing_and_of_clashing_columns(nothing, messy):
    assert mixing.mixture(nothing).isEmpty()
    df = clashing(messy)
    out = mixing.mixture(df)
    assert out.columns == [*df.columns, "copy"] and out.filter("size <> 'mine'").isEmpty()


# --- substrings ---------------------------------------------------------------
def _brute_removed(rows, n):
    docs = [(r[0], (r[1] or "").encode().split()) for r in rows]
    seen = Counter(tuple(w[k:k + n]) for _, w in docs for k in range(len(w) - n + 1))
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k:k + n])] > 1:
                gone[k:k + n] = [True] * n
        yield i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()


@pytest.mark.parametrize("n,first,hot", [(35, 18, 2000), (35, 18, 2), (12, 3, 2000), (12, 3, 4), (7, 18, 2000)])
def test_repeated_windows_go(messy, messy_rows, monkeypatch, n, first, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.digest(messy, n, first).collect())
    assert got == sorted((str(i), *rest) for i, *rest in _brute_removed(messy_rows, n))


def test_levels_double():
    assert substrings.level_lengths(35, 18) == [18, 35]
    assert substrings.level_lengths(35, 9) == [9, 18, 35]
    assert substrings.level_lengths(5, 9) == [5]


def test_a_text_repeating_itself(spark, nothing):
    text = "a b c d e " * 30
    df = spark.createDataFrame([(1, text, None, None, None)], SCHEMA)
    assert substrings.digest(df).first()["n_removed"] == 150
    assert substrings.digest(nothing).isEmpty()


def test_removal_keeps_rows_columns_and_untouched_texts(messy, messy_rows):
    df = clashing(messy)
    out = substrings.remove_repeats(df)
    assert out.columns == df.columns and out.count() == len(messy_rows)
    removed = {i: k for i, _, k, _ in _brute_removed(messy_rows, 35)}
    before = {r[0]: r[1] for r in messy_rows}
    for r in out.collect():
        if not removed[r["doc_id"]]:
            assert r["text"] == before[r["doc_id"]]


# --- shingle join -------------------------------------------------------------
def _brute_links(rows, k=5, threshold=0.8):
    sets = [frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) for w in ((r[1] or "").encode().split() for r in rows)]
    links = defaultdict(set)
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
                links[a].add(b)
                links[b].add(a)
    low = list(range(len(rows)))
    ids = [r[0] if r[0] is not None else -1 for r in rows]
    label = {i: ids[i] for i in low}
    changed = True
    while changed:
        changed = False
        for a in links:
            for b in links[a]:
                if label[b] < label[a]:
                    label[a], changed = label[b], True
    return [(str(rows[i][0]), len(links[i]), label[i]) for i in low]


@pytest.fixture(scope="module")
def near_rows():
    import random
    rng = random.Random(11)

    base = [prose(rng, 120).split() for _ in range(12)]
    rows = []
    for j, b in enumerate(base):
        for i in range(14 if j == 0 else rng.randint(1, 4)):
            w = list(b)
            for _ in range(rng.choice((0, 1, 2, 3, 6))):
                w[rng.randrange(len(w))] = "new" + str(rng.randrange(1000))
            rows.append((len(rows), " ".join(w), None, None, None))
    return rows + [(900, "one two three four", None, None, None), (901, "one two three four", None, None, None), (902, None, None, None, None)]


@pytest.mark.parametrize("small,block", [(256, 1024), (3, 4)])
def test_links_are_those_of_brute_force(spark, near_rows, monkeypatch, small, block):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    df = spark.createDataFrame(near_rows, SCHEMA).repartition(4)
    got = sorted((str(r["id"]), r["n_links"], r["component_id"]) for r in jaccard.near_duplicates(df).collect())
    assert got == sorted(_brute_links(near_rows))


def test_one_of_each_group_stays(spark, near_rows, messy, messy_rows, nothing):
    df = clashing(spark.createDataFrame(near_rows, SCHEMA))
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    groups = {i: c for i, _, c in _brute_links(near_rows)}
    short = {"900", "901", "902"}
    ids = [str(r["doc_id"]) for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and short <= set(ids)
    assert {groups[i] for i in ids} == set(groups.values()) and len(ids) == len(set(groups.values()))
    left = [r["doc_id"] for r in jaccard.keep_one(messy).select("doc_id").collect()]
    assert len(left) == len(messy_rows) - 4 and left.count(10) == 1 and {103, 104, 105, 106, 108, 109, None} <= set(left)
    assert jaccard.near_duplicates(nothing).isEmpty() and jaccard.keep_one(nothing).isEmpty()


def test_unlike_texts_of_one_id_or_none_all_stay(spark):
    import random
    rng = random.Random(3)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    rows = [(None, a), (None, b), (None, b + " more"), (7, c), (7, d), (8, d), (9, e), (None, e)]
    got = Counter(r["text"] for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert sum(got.values()) == 5 and {t for t in got if t != b and t != b + " more"} == {a, c, d, e}


# --- Katz ---------------------------------------------------------------------
def _brute_katz(rows, train):
    docs = [((r[1] or "").encode().lower().split() + [None], t) for r, t in zip(rows, train)]
    uni, bi = Counter(), Counter()
    for w, t in docs:
        if t:
            uni.update(w)
            bi.update(zip(["<start>", *w[:-1]], w))
    n, v, k = sum(uni.values()), len(uni), 5

    def factors(counts):
        of, d = Counter(counts), {}
        a = (k + 1) * of[k + 1] / of[1] if of[1] else 1
        for r in range(1, k + 1):
            x = ((r + 1) * of[r + 1] / (r * of[r]) - a) / (1 - a) if of[r] and a < 1 else 1
            d[r] = x if 0 < x < 1 else 1
        return lambda r: d.get(r, 1)

    d1, d2 = factors(uni.values()), factors(bi.values())
    used = sum(d1(c) * c for c in uni.values()) / n
    unknown = max(1 - used, 1 / (n + 1))
    word = lambda w: (1 - unknown) / used * d1(uni[w]) * uni[w] / n if uni[w] else unknown
    of, seen, lower = Counter(), Counter(), Counter()
    for (h, w), c in bi.items():
        of[h] += c
        lower[h] += word(w)
    for (h, w), c in bi.items():
        seen[h] += d2(c) * c / of[h]

    def p(h, w):
        if not of[h]:
            return word(w)
        left = 1 - seen[h] if 1 - seen[h] > 1e-9 else 1 / (of[h] + 1)
        if (h, w) in bi:
            return (1 - left) / seen[h] * d2(bi[h, w]) * bi[h, w] / of[h]
        return left / (1 - lower[h]) * word(w)

    for h in list(of)[:200]:  # every context sums to one
        assert sum(p(h, w) for w in [*uni, "\0"]) == pytest.approx(1)
    for w, _ in docs:
        yield (len(w), sum(x in uni for x in w), n, sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w),
               sum(math.log10(p(h, x)) for h, x in zip(["<start>", *w[:-1]], w)))


@pytest.mark.parametrize("change", [{}, {"MAX_BROADCAST_WORDS": 0}, {"PART_TOKENS": 500, "BLOCK_TOKENS": 700, "HOT_SHARE": 20}])
def test_katz_scores_are_those_of_brute_force(messy, messy_rows, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(katz, name, value)
    train = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2 for r in messy_rows]
    col = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    got = sorted(((str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
                  for r in katz.score(messy, col).collect()))
    want = sorted((str(r[0]), a, b, c, round(d, 6), round(e, 6)) for r, (a, b, c, d, e) in zip(messy_rows, _brute_katz(messy_rows, train)))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=1e-5)


def test_katz_without_rows_or_training(messy, nothing):
    assert katz.score(nothing, F.lit(True)).isEmpty()
    assert {r["score"] for r in katz.score(messy, F.lit(False)).collect()} == {0.0}


def _brute_backoff(rows, train, order):
    """Scores by the recursion as it is written, one dictionary an order."""
    docs = [((r[1] or "").encode().lower().split() + [None], t) for r, t in zip(rows, train)]
    count = [Counter() for _ in range(order + 1)]
    gram = lambda w, i, k: tuple("<s>" if j < 0 else w[j] for j in range(i - k + 1, i + 1))
    for w, t in docs:
        for i in range(len(w) if t else 0):
            for k in range(1, order + 1):
                count[k][gram(w, i, k)] += 1
    n, K = sum(count[1].values()), 5

    def factor(k):
        of = Counter(count[k].values())
        a = (K + 1) * of[K + 1] / of[1] if of[1] else 1
        d = {r: ((r + 1) * of[r + 1] / (r * of[r]) - a) / (1 - a) if of[r] and a < 1 else 1 for r in range(1, K + 1)}
        return lambda c: d[c] if c <= K and 0 < d[c] < 1 else 1
    d = [None] + [factor(k) for k in range(1, order + 1)]
    after = [defaultdict(list) for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g in count[k]:
            after[k][g[:-1]].append(g)
    used = sum(d[1](c) * c for c in count[1].values()) / n
    unknown = max(1 - used, 1 / (n + 1))
    cache = {}

    def terms(h):
        if h not in cache:
            k = len(h) + 1
            seen = after[k].get(h)
            if not seen:
                cache[h] = None
            else:
                tokens = sum(count[k][g] for g in seen)
                kept = sum(d[k](count[k][g]) * count[k][g] for g in seen) / tokens
                left = 1 - kept if 1 - kept > 1e-9 else 1 / (tokens + 1)
                cache[h] = tokens, (1 - left) / kept, left / (1 - sum(p(g[1:]) for g in seen))
        return cache[h]

    def p(g):
        k = len(g)
        c = count[k][g]
        if k == 1:
            return (1 - unknown) / used * d[1](c) * c / n if c else unknown
        t = terms(g[:-1])
        if t is None:
            return p(g[1:])
        return t[1] * d[k](c) * c / t[0] if c else t[2] * p(g[1:])

    for h in [g[:-1] for g in list(count[order])[:60]]:  # every context sums to one
        assert sum(p((*h, *w)) for w in [*count[1], ("\0",)]) == pytest.approx(1)
    return [sum(math.log10(p(gram(w, i, order))) for i in range(len(w))) for w, _ in docs]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff_scores_are_those_of_brute_force(messy, messy_rows, monkeypatch, order):
    monkeypatch.setattr(ngrams, "HELD", 700)
    rows = [*messy_rows, (200, messy_rows[3][1], None, None, None), (None, messy_rows[5][1], None, None, None), (None, None, None, None, None)]
    docs = clashing(messy.union(messy.sparkSession.createDataFrame(rows[-3:], SCHEMA)))
    train = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 != 2 for r in rows]
    col = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 != 2
    got = sorted((str(r["id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
                 for r in ngrams.score(docs, col, order).collect())
    simple = [x[:4] for x in _brute_katz(rows, train)]
    want = sorted((str(r[0]), a, b, c, round(e, 6), round(s, 6)) for r, (a, b, c, e), s in zip(rows, simple, _brute_backoff(rows, train, order)))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=1e-5)
    if order == 2:
        both = sorted((str(r["id"]), r["n_tokens"], round(r["score"], 6)) for r in katz.score(docs, col).collect())
        assert np.allclose([x[2] for x in both], [g[5] for g in got], atol=1e-5)


def test_backoff_without_rows_or_training(messy, nothing):
    assert ngrams.score(nothing, F.lit(True)).isEmpty()
    assert {r["score"] for r in ngrams.score(messy, F.lit(False)).collect()} == {0.0}


# --- language -----------------------------------------------------------------
def test_language_is_learned_and_judged(spark, nothing):
    import random


    rng = random.Random(3)
    kinds = {"xx": ("ka", "lo", "mi", "ren"), "yy": ("sch", "ück", "ent", "ber"), "zz": ("ño", "que", "asa", "ir")}
    rows = [(i, prose(rng, rng.randint(3, 60), kinds[k]), k, None, None) for i in range(400) for k in [list(kinds)[i % 3]]]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.learn_from(docs, F.col("doc_id") < 300, per_lang=60)
    odd = spark.createDataFrame([(1, None, "xx", None, None), (2, " 12 .. ", "xx", None, None), (3, "", None, None, None)], SCHEMA)
    out = clashing(docs.filter("doc_id >= 300")).select("*", langid.identify(docs, model).alias("q")).collect()
    assert sum(r["q"]["lang"] == r["lang"] for r in out) >= 0.98 * len(out) and all(0 <= r["q"]["score"] <= 1 for r in out)
    assert {(r[0]["lang"], r[0]["score"]) for r in odd.select(langid.identify(odd, model)).collect()} == {("und", 0.0)}
    assert langid.keep_known(odd, model).isEmpty() and langid.keep_known(docs, model).count() >= 395
    blank = langid.learn_from(nothing, F.lit(True))
    assert {r[0]["lang"] for r in docs.select(langid.identify(docs, blank)).collect()} == {"und"}


def test_the_language_sample_is_bounded_whatever_the_ids(spark):
    rng = random.Random(8)
    texts = [prose(rng, 8) for _ in range(3000)]
    rows = [(None, "aa" if i % 2 else "bb", t) for i, t in enumerate(texts)] + [(7, "cc", texts[0])] * 2000
    labelled = spark.createDataFrame(rows, "id long, lang string, text string")
    n = Counter(r["lang"] for r in langid._sampled(labelled, 100, 8000).collect())
    assert 60 < n["aa"] < 140 and 60 < n["bb"] < 140 and n["cc"] <= 1
    many = spark.createDataFrame([(None, f"l{i % 300}", t) for i, t in enumerate(texts)], "id long, lang string, text string")
    assert langid._sampled(many, 400, 600).count() < 700


def test_languages_of_kept_out_documents(spark):
    """No brute force tells a language: the query is held against the labels of
    the documents it did not learn from."""
    from staylens.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_langid"](spark, sf).join(docs, "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert sum(r["lang_pred"] == "und" for r in got) < 0.05 * len(got)


# --- toxicity -----------------------------------------------------------------
def test_toxic_texts_stand_out(spark, nothing):
    import random


    rng = random.Random(4)
    bad = ["grumbl", "snarkish", "vilefoo", "grumbler"]
    rows, labels = [], []
    for i in range(500):
        w = prose(rng, rng.randint(20, 120)).split()
        toxic = i % 5 == 0
        for _ in range(3 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad).upper())
        rows.append((i, " ".join(w), None, None, None))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (900, None, None, None, None), (901, "", None, None, None)], SCHEMA)
    marks = spark.createDataFrame([*labels, (7777, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks.filter("doc_id < 350 OR doc_id IS NULL"))
    got = {r["doc_id"]: r["s"] for r in clashing(docs).select("doc_id", toxicity.scorer(model)("text").alias("s")).collect()}
    test = [i for i in range(350, 500)]
    assert all((got[i] >= 0.7) == (i % 5 == 0) for i in test) and 0 <= got[900] == got[901] < 0.7
    empty = toxicity.train(nothing, marks)
    assert {r[0] for r in docs.select(toxicity.scorer(empty)("text")).collect()} == {0.0}


# --- licenses -----------------------------------------------------------------
@pytest.mark.parametrize("text,base,labels", [
    ("Released under the MIT License.", "mit", "mit"),
    ("under\nthe   (MIT) -- license", "mit", "mit"),
    ("under the mit licenses", "", ""),
    ("Apache License, Version 2.0", "apache-2", "apache-2"),
    ("CC-BY-NC 4.0 and apache license version 2", "apache-2,cc-by-nc", "apache-2,cc-by-nc,cc-by-nc-4.0"),
    ("This is licensed under the GNU General Public License, version 3.", "", "gpl-3"),
    ("SPDX-License-Identifier: LGPL-2.1", "", "lgpl-2.1"),
    ("permission is hereby granted, free of charge, to any person", "", "mit"),
    ("the mitten license of an apache", "", ""),
    (None, "", ""), ("", "", ""),
])
def test_license_labels(spark, text, base, labels):
    df = spark.createDataFrame([(1, text, None, None, None)], SCHEMA)
    r = licenses.scan(clashing(df)).select("scan.*").first()
    assert (r["base_labels"], r["labels"]) == (base, labels) and 0 <= r["score"] <= 1


def _example(parsed, pick):
    """A text that a parsed pattern should match, with the ``pick``-th
    alternative at every branch and every other optional part."""
    from re import _constants as c
    out = ""
    for op, arg in parsed:
        if op is c.LITERAL:
            out += chr(arg)
        elif op is c.SUBPATTERN:
            out += _example(arg[-1], pick)
        elif op is c.BRANCH:
            out += _example(arg[1][pick % len(arg[1])], pick)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            out += _example(arg[2], pick) * max(arg[0], pick // 8 % 2)
        elif op is c.IN:
            kinds = {c.CATEGORY_SPACE: "\n", c.CATEGORY_DIGIT: "2", c.CATEGORY_NOT_SPACE: "x"}
            kind, what = arg[pick % len(arg)]
            out += kinds[what] if kind is c.CATEGORY else chr(what)
        elif op not in (c.AT, c.ASSERT_NOT):
            raise AssertionError(op)
    return out


def test_the_prefilter_loses_nothing():
    from re import _parser
    rules = licenses.build_rules()
    first = licenses.gate(rules)
    assert "" not in first and all(r.keywords for r in rules)
    for r in rules:
        texts = {_example(_parser.parse(r.pattern.pattern), k) for k in range(16)}
        texts = [t for t in texts if r.pattern.search(t)]
        assert texts
        for t in texts:
            found = licenses.detect(t, rules, first)
            assert found and found == licenses.detect(t, rules, prefilter=False), t


@pytest.mark.parametrize("text,labels", [
    ("Released under the GPL v3", "gpl-3"), ("distributed under Apache 2.0", "apache-2"), ("Creative Commons Attribution 4.0", "cc-by-4.0"),
    ("© 2020", "copyright"), ("SPDX-License-Identifier: BSL-1.0", "boost-1.0"), ("all\nrights reserved", "all-rights-reserved"),
    ("licensed under Creative Commons Zero", "cc0"),
])
def test_labels_of_texts_without_the_usual_words(spark, text, labels):
    df = spark.createDataFrame([(1, text, None, None, None)], SCHEMA)
    assert licenses.scan(df).select("scan.labels").first()["labels"] == labels


def test_base_places_count_words(spark, nothing):
    df = spark.createDataFrame([(1, "Été x. Under the MIT license; cc by nc cc by nc é under the mit license", None, None, None)], SCHEMA)
    r = licenses.scan(df).select("scan.*").first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (17, 4, 2, 13)
    assert licenses.scan(nothing).select("scan.*").isEmpty() and len(licenses.build_rules()) > 300
    first = licenses.detect("licensed under the gnu general public license, version 3", licenses.build_rules())
    assert [x[2] for x in first] == ["gpl-3"]  # the versionless and shorter detections lie inside


LGPL = """This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version."""


@pytest.mark.parametrize("text,labels", [
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2-or-later"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2"),
    ("licensed under GPL-3.0", "gpl-3"), ("GPLv3", "gpl-3"), ("GPL v2+", "gpl-2-or-later"), ("BSD 3-Clause License", "bsd-3-clause"),
    ("Apache-2.0 OR MIT", "apache-2,mit"), ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)", "bsd-3-clause,mit"), (LGPL, "lgpl-2.1-or-later"),
    ("https://creativecommons.org/licenses/by-nc/4.0/", "cc-by-nc-4.0"), ("CC BY-NC-SA 3.0", "cc-by-nc-sa-3.0"), ("CC-BY-ND", "cc-by-nd"),
    ("the GNU GPL, version 12", "gpl"), ("a permit or bsd", ""), ("mit", ""), ("we commit or apache helicopters", ""), ("license: mitten", ""),
    ("Licensed under the Apache License, Version 2.0 (the \"License\")", "apache-2"), ("Mozilla Public License 2.0 or ISC license", "isc,mpl-2.0"),
    ("released into the public domain", "public-domain"), ("Redistribution and use in source and binary forms, with or without", "bsd"),
])
def test_signatures(text, labels):
    rules = licenses.build_rules()
    found = licenses.detect(text.lower(), rules, licenses.gate(rules))
    assert ",".join(sorted({x[2] for x in found})) == labels
    assert found == licenses.detect(text.lower(), rules, prefilter=False)


def test_suppressed_intervals_are_those_of_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        found = [(a, a + rng.randint(0, 9)) for a in (rng.randint(0, 12) for _ in range(rng.randint(0, 25)))]
        want = [k for k, (a, b) in enumerate(found) if not any(x <= a and b <= y for x, y in found[:k])]
        assert licenses._uncovered(found) == want


def test_long_texts_of_mentions_take_linear_time():
    import time
    rules = licenses.build_rules()
    first, times = licenses.gate(rules), []
    for n in (20_000, 80_000):
        start = time.process_time()
        found = licenses.detect("released under the mit license or gpl v3, " * n, rules, first)
        times.append(time.process_time() - start)
        assert len(found) == 2 * n
    assert times[1] < 8 * times[0] + 0.5


def test_base_places_are_those_of_brute_force(spark):
    rng = random.Random(6)
    words = ["under", "the", "MIT", "license", "apache", "version", "2", "cc", "by", "nc", "licenses", "é"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", "-", ".\n", "  "]) for _ in range(rng.randint(0, 4000 if i == 7 else 300))), None, None, None)
            for i in range(30)]
    rows += [rows[3], (None, rows[4][1], None, None, None), (None, rows[5][1], None, None, None)]
    got = licenses.scan(clashing(spark.createDataFrame(rows, SCHEMA))).select("doc_id", "text", "scan.*").collect()
    assert len(got) == len(rows)
    for r in got:
        seen = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"].lower())
        at = [(i, label) for i in range(len(seen)) for phrase, label in licenses.BASE if seen[i:i + len(phrase.split())] == phrase.split()]
        assert (r["n_words"], r["n_base"]) == (len(seen), len(at))
        assert (r["first_word"], r["last_word"]) == (min((i for i, _ in at), default=None), max((i for i, _ in at), default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at})) and {x for _, x in at} <= set(r["labels"].split(","))


# --- decontamination ----------------------------------------------------------
def test_benchmark_items_are_found(spark, nothing):
    import random


    rng = random.Random(9)
    common = "the of and to in a is that".split()
    rich = [a + b + c for a in ("bra", "cle", "dri", "flo", "gru") for b in ("ka", "le", "mi", "no", "pu") for c in ("rt", "st", "nd", "x")]
    sentence = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(rich) + rng.choice("aeiou") for _ in range(n))
    items = [(i, sentence(rng.randint(14, 50))) for i in range(30)] + [(90, None), (91, "too short"), (92, "")]
    rows, want = [], set()
    for i in range(120):
        body = sentence(rng.randint(0, 200))
        if i % 4 == 0:
            k = rng.randrange(30)
            w = items[k][1].split()
            if i % 8 == 0:  # a paraphrase: other words here and there, the end as it was
                for j in rng.sample(range(len(w) - 5), max(1, len(w) // 6)):
                    w[j] = "other"
            body = f"{body}\n{' '.join(w).upper()}! {sentence(30)}"
            want.add((i, k))
        rows.append((i, body, None, None, None))
    docs = spark.createDataFrame([*rows, (500, None, None, None, None), (501, "", None, None, None)], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["id"], r["item_id"]) for r in decontaminate.contaminated(clashing(docs), bench, block=16).collect()}
    assert got == want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - {i for i, _ in want} | {500, 501}
    assert decontaminate.contaminated(nothing, bench).isEmpty() and decontaminate.contaminated(docs, bench.limit(0)).isEmpty()


def _brute_matches(rows, items, exact=0.7, loose=0.5, answer=0.8):
    number = defaultdict(lambda: len(number))
    code = lambda t: np.array([number[w] for w in (t or "").split()], np.uint64)
    coded = [(i, code(t)) for i, t in items]
    for i, text in rows:
        text = code(text)
        for k, want in coded:
            n = len(want)
            if np.isin(text, want).sum() < loose * n:
                continue
            for s in range(len(text)):
                part = text[s:s + n + n // 4 + 2]
                got = decontaminate.common_subsequence(want, part) / n
                if got >= exact or got >= loose and decontaminate.common_subsequence(want[-5:], part) / 5 >= answer:
                    yield i, k
                    break


@pytest.mark.parametrize("n_texts", [60, 600, 6000])
def test_matches_are_those_of_brute_force_whatever_the_corpus(spark, n_texts):
    import random
    rng = random.Random(n_texts)
    common = ["c" + a + b for a in "abcdefgh" for b in "xyz"]
    rare = lambda: "r" + str(rng.randrange(10**6))
    items = [(k, " ".join(rng.choice(common) if rng.random() < 0.7 else rare() for _ in range(rng.randint(12, 45)))) for k in range(12)]
    rows = []
    for i in range(n_texts):
        w = [rng.choice(common) if rng.random() < 0.15 else rare() for _ in range(rng.randint(20, 60))]
        if i < 60:
            part = items[i % 12][1].split()
            for j in rng.sample(range(len(part) - 4 * (i % 2)), int(len(part) * rng.choice((0, 0.2, 0.3, 0.4, 0.5, 0.55)))):
                part[j] = rare()
            if i % 3 == 0:
                part.insert(len(part) // 2, " ".join(rare() for _ in range(len(part) // 4)))
            at = rng.randrange(len(w))
            w[at:at] = part
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["id"], r["item_id"]) for r in decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set(_brute_matches(rows, items))
    assert got == want and 30 < len(want) < 60


@pytest.mark.parametrize("rank", [256, 3])
def test_the_latent_space_is_searched_for_the_windows(spark, rank):
    """Without the items' vectors in the space nothing is found; with them no
    match of brute force is lost, whatever the rank."""
    import random
    rng = random.Random(rank)
    word = lambda: f"w{int(rng.paretovariate(0.5)) % 3000}"
    items = [(k, " ".join(word() for _ in range(rng.choice((8, 20, 45, 150))))) for k in range(20)]
    rows = []
    for i in range(90):
        w = [word() for _ in range(rng.randint(0, 400))]
        if i % 3 == 0:
            part = items[i % 20][1].split()
            for j in rng.sample(range(len(part)), int(len(part) * rng.choice((0, 0.2, 0.4)))):
                part[j] = word()
            w[len(w) // 2:len(w) // 2] = part
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "md5(text) AS crc", "text").withColumn("crc", F.col("crc").cast("binary"))
    index = decontaminate.build_index(docs, spark.createDataFrame(items, "item_no long, text string"), rank, 5, 0.5)
    pairs = lambda: {(r["id"], r["item_no"]) for r in decontaminate.search(docs, index, 0.7, 0.5, 0.8).collect()}
    want = set(_brute_matches(rows, items))
    assert pairs() == want and len(want) > 20
    index.__dict__.pop("_sought", None)
    index.latent_items[:], index.outside[:] = 0, 0
    assert pairs() == set()


def test_a_part_of_the_words_at_a_time():
    rng = np.random.default_rng(4)
    want = np.arange(20, dtype=np.uint64)
    text = rng.integers(0, 2000, 300_000).astype(np.uint64)
    for s in range(0, len(text) - 50, 997):
        text[s:s + 20] = want
    j, terms = decontaminate._rarest(want, want, np.ones(20), 0.5)
    index = decontaminate.Index(want, None, None, None, None, None, None, np.array([7]), np.array([27]), np.array([j]),
                                np.zeros(len(terms), np.uint16), np.searchsorted(terms, np.arange(21)))
    found = [x for _, _, h in decontaminate._hits(index, np.minimum(text, 19).astype(np.int64), text < 20, np.zeros(len(text), np.int64)) for x in h]
    assert set(range(0, len(text) - 50, 997)) <= set(found) and found == sorted(set(found))


def test_clean_texts_stay_beside_contaminated_ones_of_the_same_id(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(None, f"before {item} after"), (None, "a clean text"), (None, None), (5, item), (5, "another clean text"), (6, item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, (rows[1], rows[2], rows[4])))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=90), st.lists(st.integers(0, 5), max_size=90))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert decontaminate.common_subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == table[-1][-1]


@pytest.mark.parametrize("with_long", [True, False])
def test_short_benchmark_items_match_texts_that_are_the_item(spark, with_long):
    items = [(1, "Forty two."), (2, "..."), (3, "no"), (4, "forty  TWO")]
    if with_long:
        items.append((5, "the quick brown fox jumps over the lazy dog"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "forty, two"), (2, "he said forty two times"), (3, "NO"), (4, "..."), (5, None), (6, "two forty"), (None, "no!"),
         (7, "see the quick brown fox jumps over the lazy dog")], "doc_id long, text string")
    got = {(r["id"], r["item_id"], r["lcs"], r["answer"]) for r in decontaminate.contaminated(docs, bench).collect()}
    want = {(1, 1, 1.0, 1.0), (1, 4, 1.0, 1.0), (3, 3, 1.0, 1.0), (None, 3, 1.0, 1.0)}
    assert got == (want | {(7, 5, 1.0, 1.0)} if with_long else want)
