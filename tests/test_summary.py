"""Sentence boundaries, and centrality against a dense matrix."""

import random

import numpy as np

from newsloom.functions import summary as SM

TEXTS = {
    "It costs 3.5 dollars. See example.org for more! Why?": ["It costs 3.5 dollars.", "See example.org for more!", "Why?"],
    "Dr. Smith met J. R. Jones (e.g. on Monday). They spoke.": ["Dr. Smith met J. R. Jones (e.g. on Monday).", "They spoke."],
    "The U.S. economy grew, says Prof. Ito vs. others. Yes": ["The U.S. economy grew, says Prof. Ito vs. others.", "Yes"],
    "価格は3.5円です。安い！高い？\nはい": ["価格は3.5円です。", "安い！", "高い？", "はい"],
    "One line\ntwo lines... three": ["One line", "two lines...", "three"],
    "v2.0.1 is out.": ["v2.0.1 is out."],
    "...": [], "": [],
}


def test_sentence_boundaries(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: r.s for r in df.select("t", SM.sentences("t").alias("s")).collect()}
    assert got == TEXTS
    out = df.select("t", SM.extractive_summary(df.t, df.t).alias("s")).collect()
    assert next(r.s for r in out if "3.5 dollars" in r.t).startswith("It costs 3.5 dollars.")


def dense(sents, title, budget):
    """The same choice with all likenesses in a matrix."""
    vectors = SM._vectors(sents)
    words = sorted({w for v in vectors for w in v})
    b = np.array([[v.get(w, 0.0) for w in words] for v in vectors]).reshape(len(sents), len(words))
    like = b @ b.T
    own = set(title.lower().split())
    start = np.array([1.0 + len(own & v.keys()) for v in vectors])
    start /= start.sum()
    walk = np.array([row / row.sum() if row.sum() else start for row in like])
    visits = start
    for _ in range(SM.STEPS):
        visits = SM.DAMPING * visits @ walk + (1 - SM.DAMPING) * start
    left, taken, room = list(range(len(sents))), [], budget
    while left:
        score = [round(SM.BALANCE * visits[i] / visits.max() - (1 - SM.BALANCE) * max([like[i, j] for j in taken], default=0.0), 9) for i in left]
        best = left[int(np.argmax(score))]
        taken.append(best)
        room -= len(sents[best])
        left = [i for i in left if i != best and len(sents[i]) <= room]
    return sorted(taken)


def test_centrality_against_a_dense_graph():
    rng = random.Random(2)
    vocabulary = [f"w{c}{d}" for c in "abcdefgh" for d in "xyz"]
    for _ in range(60):
        sents = [" ".join(rng.choice(vocabulary[:rng.randrange(3, 24)]).replace("w", "q") for _ in range(rng.randrange(0, 9))) + "."
                 for _ in range(rng.randrange(1, 20))] + ["12."]
        assert SM.choose(sents, "qax qbx", 90) == dense(sents, "qax qbx", 90)


def test_central_summary(spark):
    topic = ["The chip plant opens in spring.", "A new chip plant is being built.", "The plant makes chips for cars.",
             "Rain fell on Tuesday.", "Cats sleep a lot.", "The plant makes chips for cars."]
    rows = [(1, " ".join(topic), "Chip plant"), (2, None, None), (3, "", "x"), (4, "One. " * 3000, None), (5, "No stop here", "")]
    got = {r.i: r.s for r in spark.createDataFrame(rows, "i int, t string, h string").select("i", SM.central_summary("t", "h", 70).alias("s")).collect()}
    assert "plant" in got[1] and "Cats" not in got[1] and got[1].count("makes chips") <= 1 and len(got[1]) <= 71
    assert got[2] is None and got[3] is None and got[4].startswith("One.") and got[5] == "No stop here"


def test_long_sentences_and_words_take_no_stack(spark):
    from newsloom.operators import keywords as KW
    rows = [("a", "word é " * 50_000 + ". 3.5 " + "x" * 60_000 + "é漢"), ("b", "नि" * 40_000)]
    df = spark.createDataFrame(rows, "id string, t string")
    got = {r.id: r.n for r in df.selectExpr("id", "t").select("id", SM.sentences("t").alias("s")).selectExpr("id", "size(s) n").collect()}
    assert got == {"a": 2, "b": 1}
    terms = {(r.doc, len(r.term)): r.tf for r in KW.term_counts(df, "id", "t").collect()}
    assert terms == {("a", 4): 50_000, ("a", 60_001): 1, ("b", 80_000): 1}


def test_the_walk_costs_less_than_one_word_by_word():
    import random
    import time
    rng = random.Random(1)
    sents = [" ".join(f"w{'abcdefghij'[int(10 * rng.random() ** 2)]}{'abcdefghij'[i % 10]}{'abcdefghij'[rng.randrange(10)]}" for i in range(30)) for _ in range(800)] + ["..."]
    vectors, start = SM._vectors(sents), [1.0 + i % 3 for i in range(801)]

    def plain():
        words = {}
        for v in vectors:
            for w, x in v.items():
                words[w] = words.get(w, 0.0) + x
        degree = [sum(x * words[w] for w, x in v.items()) for v in vectors]
        jump = visits = [x / sum(start) for x in start]
        for _ in range(SM.STEPS):
            flow = {}
            for v, d, n in zip(vectors, degree, visits):
                for w, x in v.items():
                    flow[w] = flow.get(w, 0.0) + x * n / d
            lost = sum(n for v, n in zip(vectors, visits) if not v)
            visits = [SM.DAMPING * (sum(x * flow[w] for w, x in v.items()) + lost * j) + (1 - SM.DAMPING) * j
                      for v, j in zip(vectors, jump)]
        return visits

    begun = time.process_time()
    want = plain()
    plainly = time.process_time() - begun
    begun = time.process_time()
    got = SM.centrality(vectors, start)
    took = time.process_time() - begun
    assert max(abs(a - b) for a, b in zip(got, want)) < 1e-12
    assert 2 * took < plainly
