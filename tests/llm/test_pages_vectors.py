"""Page extraction, the metric join, components, and the pipeline."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from staylens.llm import embed_join, htmltext
from staylens.llm.common import components
from staylens.llm.queries import QUERIES

from llm_data import SCHEMA, clashing, prose

SF = "/root/testdata/sf0.001"
WEIGHTS = ({"p": 1.0, "h1": 1.0, "": -1.0, "body": -1.0}, {"p": -0.1, "h1": -0.1, "article": -1.0, "b": -0.1, "br": -0.1})


# --- pages --------------------------------------------------------------------
@pytest.mark.parametrize("page,text", [
    ("<article><h1>One  two</h1><p>a &amp; b<br>c&nbsp;d</article>", "One two\na & b\nc d"),
    ("<nav><ul><li><a>menu item</a></li></ul></nav><p>word word word</p><footer>(c) us</footer>", "word word word"),
    ("<p>first part of it<div class='ad box'>buy this now</div><p>second part of it", "first part of it\nsecond part of it"),
    ("<p>shown words here<script>var t='<p>no</p>';</script> and more</p><style>p{}</style>", "shown words here and more"),
    ("<p>one two three</p><section class=comments><p>I like it a lot really</p></section>", "one two three"),
    ("<p>some <b>bold</b>ly <i>put</i> words</p><form><p>your name please enter</p></form>", "some boldly put words"),
    ("<p>a b c d</p><!-- <p>gone with the comment</p> --><aside><p>see also these things</p></aside><p>e f g h</p>", "a b c d\ne f g h"),
    ("<p>x &lt; y &#233; &copy;</p>", "x < y é ©"),
    ("<p>not closed <b>at all", "not closed at all"),
    ("<div hidden><p>hidden words are here</p></div><p>seen words are here</p>", "seen words are here"),
    ("", ""), (None, ""), ("<<<>>><p", ""), ("<p></p><p> </p>", ""),
])
def test_main_text(page, text):
    assert htmltext.extract(page, *WEIGHTS) == text


LONG = "<p>" + "good words here now " * 10 + "</p>"
PLAIN = " ".join("good words here now".split() * 10)


@pytest.mark.parametrize("page,text", [
    # names that speak about other blocks, or that stand around the whole page
    (f'<body><div class="page with-sidebar"><nav>menu</nav><article><h1>T</h1>{LONG}</article><div class="sidebar">side bar</div></div>', f"T\n{PLAIN}"),
    (f'<div class="post comments-open"><h1>T</h1>{LONG}<section class="comments">{LONG * 3}</section></div>', f"T\n{PLAIN}"),
    (f'<form id="page-form">{LONG}<p>end</p><div class="newsletter-signup"><p>your mail</p></div></form>', f"{PLAIN}\nend"),
    (f'<div class="sidebar-layout"><main>{LONG}</main><div class="cookie-notice"><p>we use them</p></div></div>', PLAIN),
    (f'{LONG}<div class="comment-list"><article><p>I like it a lot</p></article></div>', PLAIN),
    # short blocks at the ends
    (f"<article>{LONG}<h2>See</h2><ul><li>one</li><li>two</li></ul></article><p>imprint</p>", f"{PLAIN}\nSee\none\ntwo"),
    (f"<article><p>Hi.</p><div>{'x y ' * 30}</div><table><tr><td>Ok.</td></tr></table><blockquote>q</blockquote><pre>a  b</pre><p>Ok.</article>",
     f"Hi.\n{' '.join(['x y'] * 30)}\nOk.\nq\na b\nOk."),
    (f"<p>Hi.</p><blockquote>q</blockquote>{LONG}<h2>More</h2><ul><li>one</ul><p>Ok.</p>", f"Hi.\nq\n{PLAIN}\nMore\none\nOk."),
    (f"{LONG}<h2>Related</h2><ul><li><a href=x>other page</a></ul><div>imprint</div>", PLAIN),
    # quotes: only after an equals sign, and only if something closes them
    ("<a title=\"it's>ok\" x='a\">b'>t</a><p>one two three four</p>", "one two three four"),
    ("<p class=\"x>one two three</p><p>four five six</p>", "one two three\nfour five six"),
    ("<p don't>one two three</p><p can't>four five six</p>", "one two three\nfour five six"),
    ("<p hidden>gone words</p><p/>\n<p>kept words<br/>of it", "kept words\nof it"),
])
def test_regions(page, text):
    assert htmltext.extract(page, *WEIGHTS) == text


@pytest.mark.parametrize("part", ["<div>", '<a x="', "<a b='x ", "<li><div>", "<b>", "<", "<!--", "<a ", " / ", "<p a=", "<td><table>", "</p>", "<script>", "=", "<p>a "])
def test_time_grows_with_the_page(part):
    import time
    times = []
    for n in (25_000, 100_000):
        start = time.process_time()
        htmltext.extract("<p " + part * n, *WEIGHTS)
        htmltext.extract(part * n, *WEIGHTS)
        times.append(time.process_time() - start)
    assert times[1] < 10 and times[1] < 9 * times[0] + 0.5


def test_every_word_of_a_long_page_comes_back():
    words = [f"w{i}" for i in range(300_000)]
    paras = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)]
    assert htmltext.extract("<article><p>" + "</p><p>".join(paras) + "</article>", *WEIGHTS) == "\n".join(paras)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/pbr &;a'\"=!-x ", max_size=60))
def test_any_text_is_a_page(page):
    htmltext.extract(page, *WEIGHTS)


def test_best_run_is_that_of_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        page = "".join(rng.choice(["<p>good words here</p>", "<td>bad words</td>", "<p>w</p>", "<hr>"]) for _ in range(8))
        words, tags = {"p": 1.0, "td": -0.7}, {"p": -0.3, "td": -0.6, "hr": -2.0}
        score = [(len(t.split()) * words.get(n, 0.5) if t.split() else 0.0) if k == "t" else tags.get(n, -0.5)
                 for k, n, t, _, _ in htmltext.tokens(page)]
        best = max((sum(score[i:j]) for i in range(len(score)) for j in range(i + 1, len(score) + 1)), default=0)
        got = htmltext.extract(page, words, tags)
        good = sum(len(x.split()) for x in got.split("\n"))
        assert (got == "") == (best <= 0) and (not got or good >= best)


def test_weights_are_learned_from_articles(spark):
    page = "<title>t</title><nav><a>menu</a></nav><div><span>teaser words</span></div><article><p>{}</p></article><div>imprint of us</div>"
    pages = spark.createDataFrame([(i, f"u{i}", page.format("real words " * (i + 2))) for i in range(20)]
                                  + [(50, "u", None), (51, None, ""), (0, "u0", page.format("real words " * 2))], "page_id long, url string, html string")
    w = htmltext.learn_weights(pages)
    assert w[0]["p"] > 0.5 > -0.5 > w[0]["div"]
    got = htmltext.main_text(clashing(pages), w).filter("page_id < 20").collect()
    assert len(got) == 21 and all(set(r["text"].split()) == {"real", "words"} for r in got)
    assert htmltext.learn_weights(pages.limit(0)) == ({}, {})
    assert htmltext.main_text(pages.limit(0), w).isEmpty()


# --- vectors ------------------------------------------------------------------
def _brute_groups(ids, vectors, threshold):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if o else None for v, o in zip(vectors, ok)]
    links = defaultdict(set)
    for a in range(len(ids)):
        for b in range(a):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a].add(b)
                links[b].add(a)
    for a in range(len(ids)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        yield ids[a], len(links[a]), min(ids[x] for x in seen)


@pytest.mark.parametrize("cell,block", [(4096, 8192), (9, 5)])
def test_vector_groups_are_those_of_brute_force(spark, monkeypatch, cell, block):
    monkeypatch.setattr(embed_join, "HOME_BLOCK", block)
    monkeypatch.setattr(embed_join, "HELD_BLOCK", block + 2)
    monkeypatch.setattr(embed_join, "TILE", 4)
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(8):
        c = rng.normal(size=6)
        vectors += [(c + rng.normal(size=6) * 0.12).astype(np.float32).tolist() for _ in range(8)]
    vectors += [vectors[3]] * 7 + [(np.array(vectors[3]) * 2).tolist(), [0.0] * 6, None, [], [1.0, None, 1.0, 1.0, 1.0, 1.0],
                                   [float("nan")] * 6, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0], [1.0, 2.0], [1.0, 2.0]]
    ids = [int(x) for x in rng.permutation(len(vectors))]
    df = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embed_join.near_duplicates(clashing(df), cell_size=cell).collect())
    assert got == sorted(_brute_groups(ids, vectors, 0.95))
    assert embed_join.near_duplicates(df.limit(0)).isEmpty()


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(45)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(300):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert {n: got.get(n, n) for n in label} == label
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# --- pipeline -----------------------------------------------------------------
def test_stages_on_awkward_rows(spark, messy, nothing):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substrings", "decontamination", "mixing"]
    for start in (clashing(messy), nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "mixing":
                assert out.columns == start.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.isEmpty()


def test_pipeline_effects(spark):
    rng = random.Random(21)
    passage = prose(rng, 70)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    clean = [(i, prose(rng, 90), "ab", f"s{i % 3}", 0) for i in range(40)]
    rows = clean + [(100, clean[0][1], "ab", "s0", 0), (101, clean[1][1] + " tail", "ab", "s0", 0),
                    (102, f"{prose(rng, 50)} {passage} {prose(rng, 40)}", "ab", "s1", 0), (103, f"{prose(rng, 60)} {passage}", "ab", "s2", 0),
                    (104, f"{prose(rng, 30)}\n{item}\n{prose(rng, 30)}", "ab", "s1", 0), (105, "... 123", "ab", "s1", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    step = lambda name, df: spark.createDataFrame(stages[name](spark, df, SF).collect(), SCHEMA)
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    docs = step("language", docs)
    assert ids(docs) == {r[0] for r in rows} - {105}
    docs = step("near_duplicates", docs)
    assert ids(docs) == {r[0] for r in rows} - {105, 100, 101}
    docs = step("substrings", docs)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    assert passage not in texts[102][0] and len(texts[102][0].split()) == 90 and len(texts[103][0].split()) == 60
    assert texts[2][0] == clean[2][1] and all(n == len(t) for t, n in texts.values())
    docs = step("decontamination", docs)
    assert ids(docs) == {r[0] for r in clean} | {102, 103}
    mixed = stages["mixing"](spark, docs, SF)
    assert mixed.columns == [*docs.columns, "copy"] and mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_queries_return_their_contract(spark):
    contract = {
        "op1": "doc_id size source_size target taken", "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op5": "doc_id held_out lang_pred score", "op6": "doc_id held_out score predicted",
        "op7": "doc_id n_words n_removed kept_sha256", "op8": "vec_id n_links component_id kept",
        "op9": "doc_id n_words n_base first_word last_word base_labels labels score", "op10": "page_id url text n_chars"}
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, query in QUERIES.items():
        op = name.split("_")[0]
        if op in contract:
            out = query(spark, SF)
            assert set(contract[op].split()) <= set(out.columns)
            if op in ("op5", "op6", "op9"):
                assert out.count() == docs
                scores = out.agg(F.min("score"), F.max("score")).first()
                assert 0 <= scores[0] and scores[1] <= 1
