"""License scans with ordered signature rules.

Rules are the hand-written regular expressions of `signatures`, over the
lower-cased text. A rule runs only where its keywords occur (keyword prefilter);
they are read off its own pattern, so that no match lacks them. Detections are
ordered by priority: the rule's weight, then the longer one, then the place in
the list. One that lies inside the interval of a better one is suppressed, in one
sweep over the ordered detections, and what is left gives the labels.

Base phrases are exact word sequences. Their places are always kept: a phrase
is found through the words themselves, whatever stands between them.

Defined results: null text is empty and has no words or labels; texts of any
length are scanned whole; equal texts get equal results; an empty table gives
an empty result; columns other than those asked for are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from re import _parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.signatures import signatures

#: Base phrases and their labels (fixed values of the contract).
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


@dataclass(frozen=True)
class Rule:
    """A signature: what it detects, how sure it is, and what must occur."""

    label: str
    weight: float
    pattern: re.Pattern
    keywords: tuple[tuple[str, ...], ...]


def _length(group: tuple[str, ...]) -> int:
    return min(len(w.encode()) for w in group)


def _keywords(parsed) -> list[tuple[str, ...]]:
    """Groups of words of a parsed pattern: whatever it matches holds one word,
    at least, of every group."""
    out, run = [], ""
    for op, arg in [*parsed, (None, None)]:
        if op is _parser.LITERAL:
            run += chr(arg)
            continue
        if len(run.encode()) > 1:
            out.append((run,))
        run = ""
        if op is _parser.SUBPATTERN:
            out += _keywords(arg[-1])
        elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and arg[0]:
            out += _keywords(arg[2])
        elif op is _parser.BRANCH:
            # of every alternative the group of the longest words
            best = [max(_keywords(x), key=_length, default=None) for x in arg[1]]
            if None not in best:
                out.append(tuple(sorted({w for g in best for w in g})))
    return out


def _rule(label: str, weight: float, pattern: str) -> Rule:
    return Rule(label, weight, re.compile(pattern), tuple(dict.fromkeys(_keywords(_parser.parse(pattern)))))


def gate(rules: list[Rule]) -> tuple[str, ...]:
    """Words of which a text with any detection holds at least one: a group of
    every rule, not of short words if there is another, the one that most have."""
    shared = Counter(g for r in rules for g in r.keywords)
    words = {w for r in rules for w in max(r.keywords, key=lambda g: (min(_length(g), 5), shared[g], _length(g)), default=("",))}
    return tuple(sorted(w for w in words if not any(v != w and v in w for v in words)))


def build_rules() -> list[Rule]:
    """All rules, best kind first, as listed."""
    return [_rule(*x) for x in signatures()]


def _uncovered(found: list[tuple[int, int]]) -> list[int]:
    """Numbers of the intervals that no earlier one of the list contains. A tree
    over the starts holds the furthest end of those seen so far."""
    starts = sorted({a for a, _ in found})
    place = {a: i + 1 for i, a in enumerate(starts)}
    furthest = [-1] * (len(starts) + 1)
    out = []
    for k, (a, b) in enumerate(found):
        i, most = place[a], -1
        while i:
            most = max(most, furthest[i])
            i &= i - 1
        if most >= b:
            continue
        out.append(k)
        i = place[a]
        while i < len(furthest):
            furthest[i] = max(furthest[i], b)
            i += i & -i
    return out


def detect(text: str, rules: list[Rule], first: Sequence[str] = ("",), prefilter: bool = True) -> list[tuple[int, int, str, float]]:
    """(start, end, label, weight) of the detections that no better one
    contains. ``first`` is the `gate` of the rules; ``prefilter`` changes no
    result."""
    if prefilter and not any(w in text for w in first):
        return []
    has: dict = {}
    found = []
    for number, r in enumerate(rules):
        for g in r.keywords if prefilter else ():
            if g not in has:
                has[g] = any(w in text for w in g)
            if not has[g]:
                break
        else:
            part = "at" if r.pattern.groupindex else 0
            found += [(-r.weight, a - b, number, a, b) for a, b in (m.span(part) for m in r.pattern.finditer(text))]
    found.sort()
    kept = _uncovered([x[3:] for x in found])
    return [(found[k][3], found[k][4], rules[found[k][2]].label, rules[found[k][2]].weight) for k in kept]


_WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
_GAP = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _base_patterns():
    out = []
    for phrase, label in BASE:
        words = phrase.encode().split()
        body = _GAP.join(re.escape(w) for w in words)
        out.append((words[0] + b"", max(words, key=len), re.compile(rb"(?<!" + _WORD + rb")(?=" + body + rb"(?!" + _WORD + rb"))" + re.escape(words[0])), label))
    return out


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def scan(docs: DataFrame, text_col: str = "text"):
    """Add a struct column `scan` of `RESULT` to ``docs``."""

    @F.arrow_udf(RESULT)
    def run(column):
        import pyarrow as pa

        from staylens.llm.words import ALNUM, LOWER, pieces, text_buffer, word_bounds
        (rules, first_words), base = _rules(), _base_patterns()
        n, places, first, last, bl, al, sc = [], [], [], [], [], [], []
        for _, _, data, off in pieces(*text_buffer(column)):
            low = LOWER[data]
            starts, _, counts = word_bounds(low, off, ALNUM)
            n.append(counts)
            upto = np.concatenate([[0], np.cumsum(counts)])
            whole = low.tobytes()
            for i in range(len(counts)):
                t = whole[off[i]:off[i + 1]]
                at, found = [], set()
                for _, rare, pattern, label in base:
                    if rare in t:
                        here = [m.start() for m in pattern.finditer(t)]
                        if here:
                            at += here
                            found.add(label)
                at = np.searchsorted(starts[upto[i]:upto[i + 1]], np.array(at, np.int64) + off[i])
                more = detect(t.decode("utf-8", "replace"), rules, first_words)
                places.append(len(at))
                first.append(int(at.min()) if len(at) else None)
                last.append(int(at.max()) if len(at) else None)
                bl.append(",".join(sorted(found)))
                al.append(",".join(sorted(found | {x[2] for x in more})))
                sc.append(1.0 if found else max((x[3] for x in more), default=0.0))
        n = np.concatenate(n) if n else np.zeros(0, np.int64)
        cols = [pa.array(n, pa.int64()), pa.array(places, pa.int64()), pa.array(first, pa.int64()),
                pa.array(last, pa.int64()), pa.array(bl, pa.string()), pa.array(al, pa.string()), pa.array(sc, pa.float64())]
        return pa.StructArray.from_arrays(cols, [x.split()[0] for x in RESULT.split(", ")])

    return docs.withColumn("scan", run(F.col(text_col)))


_RULES: list[Rule] = []
_GATE: list[str] = []


def _rules() -> tuple[list[Rule], list[str]]:
    if not _RULES:
        _GATE.extend(gate(build_rules()))
        _RULES.extend(build_rules())
    return _RULES, _GATE
