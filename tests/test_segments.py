"""Unsupervised words of unspaced scripts against a plain version, terms of
all scripts, composed and decomposed text."""

import collections
import math
import random
import re
import unicodedata

from pyspark.sql import functions as F

from newsloom.operators import keywords as KW
from newsloom.operators import segments as SG

# Words of the fitting corpus.
WORDS = "東京都 半導体 工場 建設 計画 発表 市場 株価 上昇 政府 経済 新聞 大学 研究 開発 電池 輸出 会議 首相 予算".split()
TARGET = "東京都半導体工場建設計画発表"


def corpus(rng, n=300):
    return ["、".join("".join(rng.choice(WORDS) for _ in range(rng.randrange(2, 7))) for _ in range(4)) + "。の" for _ in range(n)]


def brute_lexicon(runs):
    count, sides = collections.Counter(), collections.defaultdict(lambda: (collections.Counter(), collections.Counter()))
    for run, n in runs.items():
        for at in range(len(run)):
            for size in range(1, min(SG.MAX_WORD, len(run) - at) + 1):
                g = run[at:at + size]
                count[g] += n
                sides[g][0][run[at - 1] if at else None] += n
                sides[g][1][run[at + size] if at + size < len(run) else None] += n
    total = sum(c for g, c in count.items() if len(g) == 1)
    out = {}
    for g, c in count.items():
        if len(g) < 2 or c < SG.MIN_COUNT:
            continue
        cohesion = round(min(math.log(c * total / (count[g[:k]] * count[g[k:]])) for k in range(1, len(g))), 6)
        branching = round(min(math.log(c) - sum(x * math.log(x) for s, x in side.items() if s is not None) / c for side in sides[g]), 6)
        if cohesion >= SG.MIN_COHESION and branching >= SG.MIN_BRANCHING:
            out[g] = round((cohesion + branching) * 1000) * (len(g) - 1)
    return out


def brute_split(run, words):
    best = [(0, [])]
    for end in range(1, len(run) + 1):
        ways = [(best[end - 1][0], 1)] + [(best[end - k][0] + words[run[end - k:end]], k)
                                          for k in range(2, min(SG.MAX_WORD, end) + 1) if run[end - k:end] in words]
        score, k = max(ways)
        best.append((score, best[end - k][1] + [run[end - k:end]]))
    return best[-1][1]


def test_segmentation_against_a_plain_version(spark):
    texts = corpus(random.Random(3)) + [TARGET, "漢", "", None, "long " + "半導体" * 400, "経済" * 3 + "Mix経済カタカナ市場"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    runs = SG.runs(docs, "id", "text")
    weights = collections.Counter(r for t in texts for r in re.findall(r"[一-鿿]{2,}", t or ""))
    assert {r.run: r.n for r in runs.groupBy("run").agg(F.sum("n").alias("n")).collect()} == weights
    words = SG.lexicon(runs)
    want = brute_lexicon(weights)
    got = {r.word: r.score for r in words.collect()}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) <= 3 for w in got)
    cut = {r.run: r.words for r in SG.split(runs.select("run").distinct(), words).collect()}
    assert cut == {r: brute_split(r, got) for r in weights}
    assert "半導体" in cut[TARGET] and "".join(cut[TARGET]) == TARGET
    assert {"東京都", "半導体", "工場", "建設", "計画", "発表"} == set(cut[TARGET])
    terms = {r.term for r in KW.term_counts(docs.filter(F.col("text") == TARGET), "id", "text", words).collect()}
    assert "半導体" in terms and TARGET not in terms
    assert SG.lexicon(SG.runs(docs.limit(0), "id", "text")).count() == 0
    assert SG.split(runs.select("run").limit(0), words).count() == 0


def test_keywords_of_a_segmented_corpus(spark):
    texts = corpus(random.Random(4), 100) + [TARGET + "。" + TARGET]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    words = SG.lexicon(SG.runs(docs, "doc_id", "text"))
    top = [r for r in KW.keyword_terms(docs, lexicon=words).collect() if r.doc_id == 100]
    assert {r.term: r.tf for r in top}["半導体"] == 2 and all(len(r.term) <= SG.MAX_WORD for r in top)


def test_terms_of_all_scripts(spark):
    text = {"tamil": "தமிழ்நாடு அரசு அறிவிப்பு", "bengali": "বাংলাদেশ সরকার", "georgian": "საქართველო მთავრობა",
            "composed": unicodedata.normalize("NFC", "café déjà voilà"), "decomposed": unicodedata.normalize("NFD", "café déjà voilà"),
            "latin": "ÜBER straße naïve × ÷ ab", "mixed": "abc東京タワーはdef 한국어 Привет", "none": "12 -- の は"}
    docs = spark.createDataFrame(list(text.items()), "id string, text string")
    got = collections.defaultdict(set)
    for r in KW.term_counts(docs, "id", "text").collect():
        got[r.doc].add(r.term)
    assert got["tamil"] == {"தமிழ்நாடு", "அரசு", "அறிவிப்பு"} and got["bengali"] == {"বাংলাদেশ", "সরকার"}
    assert got["georgian"] == {"საქართველო", "მთავრობა"}
    assert got["composed"] == got["decomposed"] == {"café", "déjà", "voilà"}
    assert got["latin"] == {"über", "straße", "naïve"}
    assert got["mixed"] == {"abc", "東京", "タワー", "def", "한국어", "привет"} and not got["none"]


def test_long_runs_and_large_lexicons(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice(WORDS) for _ in range(6000)), TARGET + "、" + TARGET + "𠀀𠀁𠀀", "none", None, TARGET + "の" + TARGET]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    words = spark.createDataFrame([(w, 100 + i) for i, w in enumerate(WORDS)] + [("都半", 150), ("𠀀𠀁", 7)], "word string, score long")
    scores = {r.word: r.score for r in words.collect()}
    want = {i: [w for run in re.findall(r"[一-鿿𠀀-𪛟]{2,}", t or "") for w in brute_split(run, scores)] for i, t in enumerate(texts)}
    cut = SG.with_words(docs, "text", words)
    assert {r.id: r.words for r in cut.collect()} == want
    # The texts are split where they are: nothing is shuffled for it.
    assert "hashpartitioning" not in cut._jdf.queryExecution().toString()
    monkeypatch.setattr(SG, "BROADCAST_WORDS", 3)
    assert {r.id: r.words for r in SG.with_words(docs, "text", words).collect()} == want
