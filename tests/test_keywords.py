"""Keyword terms over tables with repeated and null ids, whatever part of the
frequencies is broadcast."""

import collections
import math
import random
import re

import pytest

from newsloom.operators import keywords as KW


def brute(rows, k):
    counts = collections.defaultdict(collections.Counter)
    for doc, text in rows:
        counts[doc].update(re.findall("[a-z]{3,}", (text or "").lower()))
    df = collections.Counter(t for c in counts.values() for t in c)
    out = set()
    for doc, c in counts.items():
        ranked = sorted(c, key=lambda t: (-round(c[t] * (math.log((len(rows) + 1) / (df[t] + 1)) + 1), 9), t))
        out |= {(doc, i + 1, t, c[t], df[t]) for i, t in enumerate(ranked[:k])}
    return out


@pytest.mark.parametrize("broadcast", [0, 20, 1000])
def test_top_terms_whatever_is_broadcast(spark, monkeypatch, broadcast):
    monkeypatch.setattr(KW, "BROADCAST_TERMS", broadcast)
    rng = random.Random(8)
    words = ["w" + "abcdefghij"[i // 10] + "abcdefghij"[i % 10] for i in range(100)]
    rows = [(None if i % 19 == 0 else i // 2 if i < 20 else i,
             None if i % 23 == 0 else " ".join(words[int(100 * rng.random() ** 3)] for _ in range(40))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in KW.keyword_terms(docs, k=5).drop("score").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 5)


def test_common_terms_are_not_shuffled(spark):
    docs = spark.range(0, 400, 1, 4).selectExpr("id AS doc_id", "concat('common words in every text ', CAST(id AS STRING)) AS text")
    plan = KW.keyword_terms(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(doc" in plan and "Exchange hashpartitioning(term" not in plan
