"""Extractive summary in the article's own language, built-in expressions only.

Every sentence of the whole text is scored by how many distinct title words it
contains; sentences are taken in score order (earlier first on ties) while
the running length stays within the budget (the best sentence always), and
printed in document order. Per row, no shuffle, no Python.

:func:`central_summary` chooses by the text itself instead: sentences that
share words make a graph, the ones that a biased random walk over it visits
most are central, and each one taken lowers those like it.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import strip_unicode

# Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Jr", "Sr", "Gen", "Gov", "Sen", "Rep", "Inc", "Ltd", "Co", "Corp",
                 "No", "Fig", "Vol", "vs", "e\\.g", "i\\.e", "cf", "al")


def _sentence_pattern(stops: str, once: str = "+") -> str:
    """Sentences: up to a run of stops. No stop is a full stop between
    letters or digits (3.5, example.org, U.S), behind an abbreviation or
    behind a single capital (J. Smith). Nothing has to be given back, so in
    Java the repetition is possessive: it takes no stack on long sentences."""
    short = "(?:(?:" + "|".join(ABBREVIATIONS) + r")\.|(?:\p{Lu}\.)+)"
    return rf"(?:{short})?(?:[ (]{short}|\.[\p{{L}}\p{{N}}]|[^{stops}\n])+{once}[{stops}]*"


SENTENCE_RE = _sentence_pattern(".!?。！？")
SENTENCE_RE2 = _sentence_pattern(".!?。！？", "")  # the same in RE2 syntax
# Same pattern for texts without the ideographic terminators: identical
# matches there, and Java's regex engine runs a Latin-1 class ~10x faster.
_SENTENCE_RE_ASCII = _sentence_pattern(".!?")
_CJK_STOPS = ("。", "！", "？")
WORD_RE = r"\p{L}+"
DEFAULT_BUDGET = 200  # characters, the length the reference asks its summariser for


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def sentences(text) -> Column:
    t = _c(text)
    has_cjk = F.contains(t, F.lit(_CJK_STOPS[0]))
    for stop in _CJK_STOPS[1:]:
        has_cjk = has_cjk | F.contains(t, F.lit(stop))
    raw = F.when(F.coalesce(has_cjk, F.lit(False)), F.regexp_extract_all(t, F.lit(SENTENCE_RE), 0)) \
           .otherwise(F.regexp_extract_all(t, F.lit(_SENTENCE_RE_ASCII), 0))
    return F.filter(F.transform(raw, strip_unicode), lambda s: s != F.lit(""))


def words(text) -> Column:
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_RE), 0)


def extractive_summary(text, title, budget: int = DEFAULT_BUDGET) -> Column:
    sents = sentences(text)
    # Inside a lambda, an outer expression is re-evaluated for every element.
    # Hand the title words in as data (evaluated once per row) instead.
    tw = F.array_distinct(words(title))
    pairs = F.arrays_zip(sents.alias("s"), F.array_repeat(tw, F.size(sents)).alias("tw"))
    scored = F.transform(pairs, lambda p, i: F.struct(
        (-F.size(F.array_intersect(words(p["s"]), p["tw"]))).alias("neg_score"),
        i.alias("pos"), p["s"].alias("s"), F.char_length(p["s"]).alias("len")))
    ranked = F.array_sort(scored)
    start = F.struct(F.lit(0).alias("total"), F.lit(False).alias("stop"),
                     F.array().cast("array<struct<pos:int,s:string>>").alias("kept"))

    def step(acc, x):
        take = ~acc["stop"] & ((F.size(acc["kept"]) == 0) | (acc["total"] + x["len"] <= F.lit(budget)))
        kept = F.concat(acc["kept"], F.array(F.struct(x["pos"].alias("pos"), x["s"].alias("s"))))
        return F.when(take, F.struct((acc["total"] + x["len"]).alias("total"),
                                     F.lit(False).alias("stop"), kept.alias("kept"))) \
                .otherwise(F.struct(acc["total"].alias("total"), F.lit(True).alias("stop"),
                                    acc["kept"].alias("kept")))

    chosen = F.aggregate(ranked, start, step)["kept"]
    out = F.array_join(F.transform(F.array_sort(chosen), lambda x: x["s"]), " ")
    return F.nullif(out, F.lit(""))


#: Share of the walk's steps that follow the graph, the number of steps, and
#: the weight of centrality against likeness to what was taken.
DAMPING, STEPS, BALANCE = 0.85, 30, 0.7


def _vectors(sents: list[str]) -> list[dict[str, float]]:
    """Words of each sentence weighted by how few sentences have them, at
    unit length (a sentence without words is empty)."""
    bags = []
    for s in sents:
        bag: dict[str, float] = {}
        for w in re.findall(r"[^\W\d_]+", s.lower()):
            bag[w] = bag.get(w, 0.0) + 1.0
        bags.append(bag)
    have: dict[str, int] = {}
    for bag in bags:
        for w in bag:
            have[w] = have.get(w, 0) + 1
    out = []
    for bag in bags:
        v = {w: n * math.log(1 + len(sents) / have[w]) for w, n in bag.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: x / norm for w, x in v.items()} if norm else {})
    return out


class _Graph:
    """Sentences and their words as arrays: entry ``i`` is word ``word[i]`` of
    sentence ``row[i]`` with weight ``x[i]``."""

    def __init__(self, vectors: list[dict[str, float]]):
        number: dict[str, int] = {}
        self.word = np.array([number.setdefault(w, len(number)) for v in vectors for w in v], np.int64)
        self.x = np.array([x for v in vectors for x in v.values()])
        self.size = np.array([len(v) for v in vectors])
        self.row = np.repeat(np.arange(len(vectors)), self.size)
        self.words = len(number)

    def handed_on(self, n: np.ndarray) -> np.ndarray:
        """Likenesses times ``n``: by way of the words, without listing them."""
        flow = np.bincount(self.word, self.x * n[self.row], self.words)
        return np.bincount(self.row, self.x * flow[self.word], len(self.size))

    def visits(self, start: list[float]) -> np.ndarray:
        jump = np.array(start) / sum(start)
        empty = self.size == 0
        share = np.where(empty, 1.0, self.handed_on(np.ones(len(self.size))))
        visits = jump
        for _ in range(STEPS):
            visits = DAMPING * (self.handed_on(visits / share) + visits[empty].sum() * jump) + (1 - DAMPING) * jump
        return visits


def centrality(vectors: list[dict[str, float]], start: list[float]) -> list[float]:
    """Share of a random walk's visits to each sentence. A step goes to a
    sentence in proportion to its likeness (cosine, itself included) or, once
    in a while, to one dealt by ``start``. The likenesses are never listed: a
    sentence hands its visits to its words and the words hand them on, so a
    step is linear in the text."""
    return _Graph(vectors).visits(start).tolist()


def choose(sents: list[str], title: str, budget: int) -> list[int]:
    """Places of the chosen sentences, ascending: the best one, then whichever
    still fits into ``budget`` characters, by centrality less likeness to
    those taken (earlier first on ties)."""
    vectors = _vectors(sents)
    own = set(re.findall(r"[^\W\d_]+", title.lower()))
    graph = _Graph(vectors)
    visits = graph.visits([1.0 + len(own & v.keys()) for v in vectors])
    central = BALANCE * visits / visits.max()
    taken: list[int] = []
    alike = np.zeros(len(sents))
    length = np.array([len(s) for s in sents])
    left, room = np.ones(len(sents), bool), budget
    while left.any():
        worth = np.where(left, central - (1 - BALANCE) * alike, -np.inf)
        near = np.flatnonzero(worth >= worth.max() - 2e-9).tolist()
        best = min(near, key=lambda i: (-round(float(worth[i]), 9), i))
        taken.append(best)
        room -= len(sents[best])
        left &= length <= room
        left[best] = False
        if left.any():
            one = np.zeros(len(sents))
            one[best] = 1.0
            alike = np.maximum(alike, graph.handed_on(one))
    return sorted(taken)


@F.pandas_udf(T.StringType())
def _central(sents: pd.Series, title: pd.Series, budget: pd.Series) -> pd.Series:
    return pd.Series([" ".join(s[i] for i in choose(list(s), t or "", int(b))) if s is not None and len(s) else None
                      for s, t, b in zip(sents, title, budget)], dtype="object")


def central_summary(text, title, budget: int = DEFAULT_BUDGET) -> Column:
    """Summary by sentence centrality, with words of the title drawing the
    walk; NULL for a text without sentences."""
    return _central(sentences(text), _c(title), F.lit(budget))
