"""Main text of web pages as the maximum-scoring run of page tokens.

A page is a sequence of tokens: text runs and tags. Each word scores what its
place in the page is worth, each tag scores below zero, and one linear scan
finds the contiguous run of tokens with the largest sum. The worth of places
and tags is learned from labelled pages: those with exactly one <article>
element, whose words are the positive ones. If most words of the run stand in
one <article> or <main> element, the region is that element, so short blocks at
its ends stay; else the run takes in the paragraphs, headings, lists and tables
next to it, up to the next container. Text of the region that stands in menus,
forms, adverts and the like is left out, and the rest is written block by block.

What such blocks are is told by their element and by the words of their names.
Names that only speak about such a block (`with-sidebar`) say nothing, and no
name rules out a block that holds most words of the page together with its
first <article>, <main> or <h1>, or nearly all words where there is none.

A page is read in one pass; time and memory grow with its length, however many
tags and quotes are left open.

The weights are fitted on a bounded sample of pages (``max_pages``, by a hash
of the page id); every page is extracted from its whole html.

Defined results: null or empty html gives empty text, as does a page without
positive words; broken markup is read as far as it goes; equal pages get equal
results; no labelled page leaves the prior weights; other columns pass through.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN = re.compile(r"</?[a-zA-Z][a-zA-Z0-9:-]*+|<!--|<[!?]|<")
#: The next attribute of a tag: a name, and whether a value follows.
SPACE = re.compile(r"[\s/]++")
ATTR = re.compile(r"(?:([^\s/>=]++)|=)(\s*+=\s*+)?")
VALUE = re.compile(r"[^\s>]*+")
READ = frozenset("class id role hidden aria-hidden style".split())

#: Elements whose content is not markup, elements without content, inline ones.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split())
#: Elements that stand inside a paragraph without ending it.
PHRASING = INLINE | frozenset(
    "script style noscript template button select textarea input label iframe object svg math canvas video "
    "audio map datalist embed".split())
#: Elements that never hold article text.
CHROME = frozenset(
    "head nav footer aside form script style noscript template button select option textarea input label "
    "iframe object svg math canvas video audio dialog menu title map datalist fieldset".split())
#: Words of class, id and role names that mark what is not the article.
CHROME_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent "
    "gdpr notice notices alert popup modal overlay comment comments disqus reply replies respond discussion "
    "social share sharing related recommended newsletter subscribe subscription signup login search widget "
    "pagination pager contentinfo complementary dialog paywall skip toolbar".split())
#: Words beside them that leave a name a block of that kind, and words that
#: make it a statement about another block.
PLAIN_NAMES = frozenset(
    "site page top bottom left right main global primary secondary box block area section container wrapper wrap "
    "inner outer list item items bar links link posts post content contents body text title form panel module "
    "group row col column unit slot region the my".split())
STATE_NAMES = frozenset(
    "with without has have no not non is are show shows hide hides open opened closed enabled disabled on off allow "
    "allowed free less".split())
#: Containers that names never rule out, elements that may stand around a whole page.
BODY = frozenset("html body main article".split())
AROUND = frozenset("form fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that a run takes in when they stand next to it.
CONTENT = HEADINGS | frozenset(
    "p ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure figcaption hr br".split())
LISTED = frozenset("li td th dt dd".split())

UNKNOWN_WORD, UNKNOWN_TAG, CHROME_RUN, CHROME_TAG = 0.5, -0.5, -0.5, -0.25
NONE, PART, NAMED, ALWAYS = range(4)
MOST, NEARLY_ALL = 0.5, 0.9


def _mark(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """How surely an element is not article text: `ALWAYS` by its kind,
    `NAMED` by a whole name, `PART` by a word of a name."""
    if tag in AROUND:
        return NAMED
    if tag in CHROME or (tag == "header" and not in_article):
        return ALWAYS
    if tag in BODY or not attrs:
        return NONE
    best = NONE
    for name, value in attrs.items():
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return ALWAYS
        if name == "style":
            if re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value):
                return ALWAYS
        elif name != "aria-hidden":
            for one in value.split():
                words = {w for w in re.split(r"[^a-z0-9]+", one) if w}
                if words & CHROME_NAMES and not words & STATE_NAMES:
                    best = max(best, NAMED if words <= CHROME_NAMES | PLAIN_NAMES else PART)
    return best


class Page:
    """A page read once: its tokens (kind, name, text, element) and, by number
    of the element, its parent, what it is, and whether it is ruled out. Kind "t"
    is a text run with ``name`` its innermost block element, "b" a tag that
    ends a block, "i" an inline tag."""

    def __init__(self, page: str):
        self.tokens: list[tuple[str, str, str, int]] = []
        self.parent, self.tag, self.block, self.mark = [-1], [""], [""], [NONE]
        #: The outermost <article> and <main> around an element, and whether it stands in a link.
        self.article, self.main, self.link = [-1], [-1], [False]
        self._read(page)
        self._rule()

    def _read(self, page: str) -> None:
        stack, where, at, n = [0], {}, 0, len(page)
        gone = set()  # what comes nowhere any more

        def find(what: str, start: int) -> int:
            if what in gone:
                return -1
            i = page.find(what, start)
            if i < 0:
                gone.add(what)
            return i

        def cut(depth: int) -> None:
            while len(stack) > depth:
                where[self.tag[stack.pop()]].pop()

        def last(tag: str) -> int:
            return where[tag][-1] if where.get(tag) else 0

        while at < n:
            m = OPEN.search(page, at)
            text = page[at:m.start()] if m else page[at:]
            if text:
                self.tokens.append(("t", self.block[stack[-1]], text, stack[-1]))
            if m is None:
                return
            got, at = m[0], m.end()
            if got == "<":
                self.tokens.append(("t", self.block[stack[-1]], "<", stack[-1]))
                continue
            if got == "<!--":
                i = find("-->", at)
                at = n if i < 0 else i + 3
                continue
            if got[1] in "!?":
                i = find(">", at)
                at = n if i < 0 else i + 1
                continue
            closing = got[1] == "/"
            tag = got[2 if closing else 1:].lower()
            attrs, own_end = {}, False
            while at < n and page[at] != ">":
                a = SPACE.match(page, at)
                if a:
                    own_end, at = a[0].endswith("/"), a.end()
                    continue
                a = ATTR.match(page, at)
                at, value, own_end = a.end(), "", False
                if a[2] and at < n:
                    quote = page[at]
                    i = find(quote, at + 1) if quote in "\"'" else -1
                    if i >= 0:
                        value, at = page[at + 1:i], i + 1
                    else:  # no quotes, or one that nothing closes
                        v = VALUE.match(page, at)
                        value, at = v[0], v.end()
                        own_end = value.endswith("/")
                name = (a[1] or "").lower()
                if name in READ and name not in attrs:
                    attrs[name] = value.lower()
            at += 1
            inside = self.article[stack[-1]] >= 0
            if closing:
                if where.get(tag):
                    cut(last(tag))
            else:
                if tag not in PHRASING and tag not in VOID and last("p"):
                    cut(where["p"][0])
                if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
                    if last(tag) > max(map(last, ("ul", "ol", "table", "dl", "select", "tbody"))):
                        cut(last(tag))
                if tag not in VOID and not own_end:
                    up, e = stack[-1], len(self.tag)
                    self.parent.append(up)
                    self.tag.append(tag)
                    self.block.append(self.block[up] if tag in INLINE else tag)
                    self.mark.append(_mark(tag, attrs, inside))
                    self.article.append(e if tag == "article" and self.article[up] < 0 else self.article[up])
                    self.main.append(e if tag == "main" and self.main[up] < 0 else self.main[up])
                    self.link.append(tag == "a" or self.link[up])
                    where.setdefault(tag, []).append(len(stack))
                    stack.append(e)
            self.tokens.append(("i" if tag in PHRASING else "b", tag, "", stack[-1]))
            if tag in RAW and not closing:
                end = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
                at = end.end() if end else n
                if self.tag[stack[-1]] == tag:
                    cut(len(stack) - 1)

    def _rule(self) -> None:
        """`out` by element: names are weighed against the words they would rule out."""
        n = len(self.tag)
        never = [False] * n
        for e in range(n):
            never[e] = self.mark[e] == ALWAYS or (e > 0 and never[self.parent[e]])
        words = [0] * n
        for kind, _, text, e in self.tokens:
            if kind == "t" and not never[e]:
                words[e] += len(text.split())
        for e in range(n - 1, 0, -1):
            words[self.parent[e]] += words[e]
        holds = [False] * n
        anchor = next((e for e in range(n) if self.tag[e] in ("article", "main", "h1") and not never[e]), -1)
        e = anchor
        while e >= 0:
            holds[e], e = True, self.parent[e]
        self.out = [False] * n
        for e in range(1, n):
            kept = (words[e] > MOST * words[0] and (holds[e] or self.mark[e] == PART)) if anchor >= 0 else \
                words[e] >= (MOST if self.mark[e] == PART else NEARLY_ALL) * words[0]
            self.out[e] = self.out[self.parent[e]] or self.mark[e] == ALWAYS or (self.mark[e] != NONE and not kept)


def tokens(page: str):
    """Yield (kind, name, text, ruled out, in an article) of the tokens."""
    read = Page(page)
    for kind, name, text, e in read.tokens:
        yield kind, name, text, read.out[e], read.article[e] >= 0


def best_run(read: Page, words: dict[str, float], tags: dict[str, float]) -> tuple[int, int] | None:
    """First and last + 1 token of the run with the largest sum, if above 0."""
    best, best_span, total, start = 0.0, None, 0.0, 0
    for i, (kind, name, text, e) in enumerate(read.tokens):
        if kind == "t":
            k = len(text.split())
            score = (CHROME_RUN if read.out[e] else k * words.get(name, UNKNOWN_WORD)) if k else 0.0
        else:
            score = CHROME_TAG if read.out[e] else tags.get(name, UNKNOWN_TAG)
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_span = total, (start, i + 1)
    return best_span


def _home(read: Page, span: tuple[int, int]) -> int:
    """The <article>, else the <main>, that most words of the run stand in; -1 if none."""
    for around in (read.article, read.main):
        held: dict[int, int] = {}
        for kind, _, text, e in read.tokens[span[0]:span[1]]:
            if kind == "t" and not read.out[e]:
                held[around[e]] = held.get(around[e], 0) + len(text.split())
        top = max(held, key=lambda x: (held[x], -x), default=-1)
        if top >= 0 and 2 * held[top] > sum(held.values()):
            return top
    return -1


def _grown(read: Page, span: tuple[int, int], words: dict[str, float]) -> tuple[int, int]:
    """The run with the content blocks next to it. A heading is taken in only
    before other text."""

    def walk(order):
        end = None
        for i in order:
            kind, name, text, e = read.tokens[i]
            if kind != "t":
                if read.out[e] or not (name in CONTENT or kind == "i"):
                    break
            elif text.strip():
                if read.out[e] or name not in CONTENT or words.get(name, UNKNOWN_WORD) <= 0 or (name in LISTED and read.link[e]):
                    break
                if name not in HEADINGS or order.step < 0:
                    end = i
        return end

    left, right = walk(range(span[0] - 1, -1, -1)), walk(range(span[1], len(read.tokens), 1))
    return span[0] if left is None else left, span[1] if right is None else right + 1


def extract(page: str | None, words: dict[str, float], tags: dict[str, float]) -> str:
    """The blocks of the best region of ``page``, joined by newlines."""
    read = Page(page or "")
    span = best_run(read, words, tags)
    if span is None:
        return ""
    home = _home(read, span)
    around = read.article if home >= 0 and read.tag[home] == "article" else read.main
    if home < 0:
        span = _grown(read, span, words)
    blocks, parts = [], []
    for kind, name, text, e in [*(read.tokens if home >= 0 else read.tokens[span[0]:span[1]]), ("b", "", "", 0)]:
        if kind == "t":
            if not read.out[e] and (around[e] == home if home >= 0 else words.get(name, UNKNOWN_WORD) > 0):
                parts.append(text)
        elif kind == "b" and parts:
            block = " ".join(html.unescape("".join(parts)).split())
            if block:
                blocks.append(block)
            parts = []
    return "\n".join(blocks)


def learn_weights(pages: DataFrame, max_pages: int = 2000) -> tuple[dict, dict]:
    """(word weights by block element, tag weights) from a sample of labelled
    pages. ``pages`` has (page_id, html)."""
    draw = F.xxhash64(F.lit("html"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    labelled = pages.filter(F.lower("html").rlike(r"<article[\s>]"))
    sample = labelled.orderBy(draw, "page_id").select("page_id").limit(max_pages)
    ids = F.broadcast(sample.distinct())

    def count(batches):
        import pandas as pd
        for b in batches:
            out = {}
            for page in b["html"]:
                if len(re.findall(r"<article[\s>]", page, re.I)) != 1:
                    continue
                for kind, name, text, chrome, inside in tokens(page):
                    if chrome:
                        continue
                    k = len(text.split()) if kind == "t" else 1
                    key = (kind == "t", name[:40], inside)
                    out[key] = out.get(key, 0) + k
            yield pd.DataFrame([(*k, v) for k, v in out.items()], columns=["word", "name", "inside", "n"])

    got = (labelled.join(ids, "page_id", "left_semi").select("html")
           .mapInPandas(count, "word boolean, name string, inside boolean, n long")
           .groupBy("word", "name", "inside").agg(F.sum("n").alias("n")).collect())
    seen: dict = {}
    for r in got:
        seen.setdefault((r["word"], r["name"]), [0, 0])[r["inside"]] += r["n"]
    words, tags = {}, {}
    for (word, name), (out, inside) in seen.items():
        if word:
            words[name] = math.tanh(math.log((inside + 0.5) / (out + 0.5)) / 2)
        else:
            tags[name] = -0.1 - 2.0 * (out + 0.5) / (out + inside + 1)
    return words, tags


def main_text(pages: DataFrame, weights: tuple[dict, dict], html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col``, the extracted text of ``html_col``."""
    words, tags = weights

    @F.arrow_udf("string")
    def text(col):
        import pyarrow as pa
        return pa.array([extract(x, words, tags) for x in col.to_pylist()], pa.string())

    return pages.withColumn(out_col, text(F.col(html_col)))
