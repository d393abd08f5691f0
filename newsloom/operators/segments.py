"""Words of scripts written without spaces, found without a dictionary.

A run of Han characters is cut where the corpus says so. N-grams of the
corpus' runs (up to :data:`MAX_WORD` characters) are counted with their
neighbours. An n-gram is a word if it is frequent, its parts stick together
(the lowest pointwise mutual information over its cuts) and what stands
before and after it varies (branching entropy; a run's end counts as a
neighbour of its own each time). A run is then split into the words and
single characters whose scores have the largest sum, longer words first on
ties, by dynamic programming over its characters.

Every place of a run is read once, as the window of characters around it;
n-grams and neighbours are cut from the distinct windows. A run is split in
the task that reads it, in time linear in its length: by the whole lexicon
where that is small enough to be sent to the workers, else by its part that
occurs in the text, found by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import cut_lineage

RUN_RE = r"\p{IsHan}{2,}"
RUN_RE2 = r"\p{Han}{2,}"  # the same in RE2 syntax
MAX_WORD = 4
MIN_COUNT = 3
MIN_COHESION = 1.0
MIN_BRANCHING = 0.5
#: Words of a lexicon that are sent to the workers at most; of a larger one
#: each text gets its own.
BROADCAST_WORDS = 200_000
_START = "^"


def runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, run, n)``: the runs of each document, one row a place (``n``
    is 1)."""
    return docs.select(F.col(id_col).alias("doc"), F.explode(_runs_of(text_col)).alias("run"), F.lit(1).cast("long").alias("n"))


def _runs_of(text_col: str) -> F.Column:
    return F.regexp_extract_all(F.col(text_col), F.lit(RUN_RE), 0)


def _grams(corpus_runs: DataFrame) -> DataFrame:
    """``(gram, before, after, n)`` of every n-gram of every run; ``before``
    and ``after`` are null at a run's ends."""
    # What stands before a place, the longest n-gram there and what follows.
    around = F.regexp_extract_all(F.concat(F.lit(_START), F.col("run")), F.lit(f"(?=(.{{1,{MAX_WORD + 2}}}))."), 1)
    windows = (corpus_runs.select(F.explode(around).alias("window"), "n").groupBy("window").agg(F.sum("n").alias("n"))
               .filter(F.char_length("window") > 1))
    sized = windows.select("window", "n", F.explode(
        F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.char_length("window") - 1))).alias("size"))
    return sized.select(
        F.substr("window", F.lit(2), F.col("size")).alias("gram"), "n",
        F.nullif(F.substr("window", F.lit(1), F.lit(1)), F.lit(_START)).alias("before"),
        F.nullif(F.substr("window", F.col("size") + 2, F.lit(1)), F.lit("")).alias("after"))


def _branching(grams: DataFrame, side: str) -> DataFrame:
    """``(gram, h_side)``: entropy of the neighbours on one side."""
    each = grams.filter(F.char_length("gram") > 1).groupBy("gram", side).agg(F.sum("n").alias("c"))
    weight = F.when(F.col(side).isNotNull(), F.col("c") * F.log(F.col("c").cast("double"))).otherwise(0.0)
    return each.groupBy("gram").agg((F.log(F.sum("c").cast("double")) - F.sum(weight) / F.sum("c")).alias(f"h_{side}"))


def lexicon(corpus_runs: DataFrame, min_count: int = MIN_COUNT, min_cohesion: float = MIN_COHESION,
            min_branching: float = MIN_BRANCHING) -> DataFrame:
    """``(word, score)`` learned from :func:`runs` of a corpus, written down.
    Scores are whole numbers, so that sums of them don't depend on order."""
    # Neighbours are kept apart up to here; everything else is a sum of these.
    around = cut_lineage(_grams(corpus_runs).groupBy("gram", "before", "after").agg(F.sum("n").alias("n")))
    counts = cut_lineage(around.groupBy("gram").agg(F.sum("n").alias("c")))
    total = counts.filter(F.char_length("gram") == 1).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("t")).first()["t"]
    often = counts.filter((F.char_length("gram") > 1) & (F.col("c") >= min_count))
    cuts = often.select("gram", "c", F.explode(F.sequence(F.lit(1), F.char_length("gram") - 1)).alias("k")).select(
        "gram", "c", F.substr("gram", F.lit(1), F.col("k")).alias("a"), F.substr("gram", F.col("k") + 1).alias("b"))
    part = lambda name: counts.select(F.col("gram").alias(name), F.col("c").alias(f"c_{name}"))
    pmi = F.log(F.col("c").cast("double") * float(total) / (F.col("c_a").cast("double") * F.col("c_b").cast("double")))
    cohesion = (cuts.join(part("a"), "a").join(part("b"), "b").groupBy("gram").agg(F.round(F.min(pmi), 6).alias("cohesion")))
    sides = _branching(around, "before").join(_branching(around, "after"), "gram")
    branching = F.round(F.least("h_before", "h_after"), 6)
    return cut_lineage(
        cohesion.join(sides, "gram").withColumn("branching", branching)
        .filter((F.col("cohesion") >= min_cohesion) & (F.col("branching") >= min_branching))
        .select(F.col("gram").alias("word"),
                (F.round((F.col("cohesion") + F.col("branching")) * 1000).cast("long") * (F.char_length("gram") - 1)).alias("score")))


def best_split(text: str, scores: dict[str, int], tails: set[str] | None = None) -> list[str]:
    """The split of ``text`` with the largest sum of scores; of equal ones
    the one whose last words are longer. Characters outside of words stand
    alone. ``tails``: last two characters of the words, which rule out most
    places at one look."""
    tails = {w[-2:] for w in scores} if tails is None else tails
    find = scores.get
    best, sizes = [0], [0]
    for end in range(1, len(text) + 1):
        top, size = best[-1], 1
        if text[end - 2:end] in tails:
            for k in range(2, min(MAX_WORD, end) + 1):
                score = find(text[end - k:end])
                if score is not None and best[end - k] + score >= top:
                    top, size = best[end - k] + score, k
        best.append(top)
        sizes.append(size)
    out, end = [], len(text)
    while end:
        size = sizes[end]
        out.append(text[end - size:end])
        end -= size
    return out[::-1]


def _spaced(text: str | None, scores: dict[str, int], tails: set[str] | None = None) -> str | None:
    return " ".join([w for w in best_split(text, scores, tails) if w != " "]) if text else None


#: Rows of a worker's step: results of a whole Arrow batch are not held.
_ROWS = 500


def _split_by(lexicon):
    """Splits by a broadcast lexicon."""
    @F.pandas_udf(T.StringType())
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores = lexicon.value
        tails = {w[-2:] for w in scores}
        for batch in texts:
            for at in range(0, len(batch), _ROWS):
                yield batch.iloc[at:at + _ROWS].map(lambda t: _spaced(t, scores, tails)).astype(object)
    return run


@F.pandas_udf(T.StringType())
def _split_own(texts: pd.Series, words: pd.Series, scores: pd.Series) -> pd.Series:
    return pd.Series([_spaced(t, {} if w is None else dict(zip(w, (int(x) for x in s))))
                      for t, w, s in zip(texts, words, scores)], dtype=object)


def with_words(docs: DataFrame, text_col: str, lexicon_words: DataFrame, out: str = "words") -> DataFrame:
    """``docs`` with the words of the runs of their text, in order (an empty
    array without runs), by the best split of every run. The lexicon is
    counted first: up to :data:`BROADCAST_WORDS` words it goes to the workers
    whole; of a larger one every row is given the words in its text, by a
    shuffle of the rows' n-grams."""
    # Runs a space apart: no word reaches from one into the next.
    joined = F.nullif(F.array_join(_runs_of(text_col), " "), F.lit(""))
    spark = docs.sparkSession
    if lexicon_words.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS:
        scores = spark.sparkContext.broadcast({r["word"]: r["score"] for r in lexicon_words.collect()})
        split_up = docs.withColumn("_split", _split_by(scores)(joined))
    else:
        rows = cut_lineage(docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_runs", joined))
        places = F.array_distinct(F.regexp_extract_all(F.col("_runs"), F.lit(f"(?=(.{{2,{MAX_WORD}}}))."), 1))
        sized = rows.select("_row", F.explode(places).alias("place")).select("_row", "place", F.explode(
            F.sequence(F.lit(2), F.char_length("place"))).alias("size"))
        grams = sized.select("_row", F.substr("place", F.lit(1), F.col("size")).alias("word")).distinct()
        own = grams.join(lexicon_words, "word").groupBy("_row").agg(F.collect_list(F.struct("word", "score")).alias("_own"))
        split_up = (rows.join(own, "_row", "left")
                    .withColumn("_split", _split_own(F.col("_runs"), F.col("_own")["word"], F.col("_own")["score"]))
                    .drop("_row", "_runs", "_own"))
    return split_up.withColumn(out, F.coalesce(F.split("_split", " "), F.array().cast("array<string>"))).drop("_split")


def split(distinct_runs: DataFrame, words: DataFrame) -> DataFrame:
    """``(run, words)``: the best split of every run by a :func:`lexicon`."""
    return with_words(distinct_runs, "run", words).select("run", "words")
