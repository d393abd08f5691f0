"""Keyword tags by TF-IDF over the corpus.

Plan: the terms of every row are found once and written down as one text a
row, dealt by document, which is about what the texts take. Counts per
(document, term) and the top-k window then need no further shuffle, and
document frequencies are a partial-then-final aggregate over the same rows (a
term present in every document costs one row per map task). The frequencies
of the :data:`BROADCAST_TERMS` commonest terms are broadcast to the counts;
only counts of the rarer ones are shuffled to theirs, and of the common ones
no more than k a document meet them again. ``salt`` joins all terms by a
salted shuffle instead.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators import segments
from newsloom.session import cut_lineage

# Runs of one script are terms: two Han or Katakana characters and more, or
# three letters and more (each with its combining marks) of any other script
# but Hiragana.
def _term_pattern(script, once: str = "") -> str:
    han, kana, other = script("Han"), script("Katakana"), script("Hiragana")
    letter = rf"[^\P{{L}}{han}{kana}{other}]"
    return rf"{han}{{2,}}|[{kana}ー]{{2,}}|(?:{letter}\p{{M}}*{once}){{3,}}{once}"


# Possessive in Java, where a repeated group takes stack on long words else.
TERM_RE = _term_pattern(lambda s: rf"\p{{Is{s}}}", "+")
TERM_RE2 = _term_pattern(lambda s: rf"\p{{{s}}}")  # the same in RE2 syntax
# The same where no character is above U+00FF: a class of that range only.
_LATIN1_RE = "[a-zªµºß-öø-ÿ]{3,}"
_KANA_AND_SPACED_RE = TERM_RE.split("|", 1)[1]
DEFAULT_K = 10
#: Terms of a frequency table that a join broadcasts at most, commonest first.
BROADCAST_TERMS = 500_000


@F.pandas_udf(T.StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def composed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the text in composed form (NFC), so that a letter and its
    mark make the same term whichever way they are written. Only texts with
    combining marks are handed to Python."""
    marked = F.when(F.col(text_col).rlike(r"\p{M}"), F.col(text_col))
    return docs.withColumn(text_col, F.coalesce(_nfc(marked), F.col(text_col)))


def terms(text: Column, pattern: str = TERM_RE) -> Column:
    """All terms of a composed text, in order."""
    low = F.lower(text)
    find = lambda p: F.regexp_extract_all(low, F.lit(p), 0)
    return F.when(low.rlike(r"[^\x00-\xFF]"), find(pattern)).otherwise(find(_LATIN1_RE))


def _term_lists(docs: DataFrame, text_col: str, lexicon: DataFrame | None) -> DataFrame:
    """``docs`` with what :func:`_terms_of` reads. All Python work is done
    here, below any shuffle of the rows."""
    own = composed(docs, text_col)
    return own if lexicon is None else segments.with_words(own, text_col, lexicon, "_words")


def _terms_of(text_col: str, lexicon: DataFrame | None) -> Column:
    if lexicon is None:
        return terms(F.col(text_col))
    return F.concat(terms(F.col(text_col), _KANA_AND_SPACED_RE), F.filter("_words", lambda w: F.char_length(w) > 1))


def term_counts(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame | None = None) -> DataFrame:
    """``(doc, term, tf)``. With a ``lexicon`` (:func:`segments.lexicon`) runs
    of Han characters are split into its words; without one they are terms as
    they are."""
    own = _term_lists(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), "text", lexicon)
    toks = own.select("doc", F.explode(_terms_of("text", lexicon)).alias("term"))
    return toks.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(corpus: DataFrame, text_col: str = "text", lexicon: DataFrame | None = None) -> DataFrame:
    """``(term, df)``; the distinct terms are taken inside each row."""
    own = _term_lists(corpus.select(text_col), text_col, lexicon)
    each = own.select(F.explode(F.array_distinct(_terms_of(text_col, lexicon))).alias("term"))
    return each.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def keyword_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  k: int = DEFAULT_K, salt: int | None = None, corpus: DataFrame | None = None,
                  lexicon: DataFrame | None = None) -> DataFrame:
    """``(id, rank, term, tf, df, score)`` for the top ``k`` terms of each
    document; ties broken by term. ``corpus`` (same text column; default
    ``docs``) is what document frequencies are counted over."""
    n_docs = (docs if corpus is None else corpus).count()  # one number reaches the driver
    own = _term_lists(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), "text", lexicon)
    # No term has a space. The lists have to meet by document: ids may repeat.
    listed = cut_lineage(own.select("doc", F.array_join(_terms_of("text", lexicon), " ").alias("listed")))
    toks = listed.filter("listed <> ''").repartition("doc").select("doc", F.explode(F.split("listed", " ")).alias("term"))
    tf = toks.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))
    dfreq = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")) if corpus is None
             else document_frequencies(corpus, text_col, lexicon))
    return top_terms(tf, cut_lineage(dfreq), n_docs, id_col, k, salt)


def top_terms(tf: DataFrame, dfreq: DataFrame, n_docs: int, id_col: str = "doc_id", k: int = DEFAULT_K,
              salt: int | None = None) -> DataFrame:
    """The top ``k`` of counted terms (:func:`term_counts`) by the document
    frequencies ``(term, df)`` of ``n_docs`` documents. The inverse frequency
    is smoothed, ``ln((1 + N) / (1 + df)) + 1``, so a corpus of one document
    still ranks its terms by how often they occur. ``dfreq`` should be written
    down: joined straight from its aggregate, a term that most documents hold
    would be one task's, as adaptive execution can't split that side."""
    idf = F.log(F.lit(float(n_docs + 1)) / (F.col("df") + 1)) + 1
    best = Window.partitionBy("doc").orderBy(F.col("score").desc(), F.col("term").asc())

    def top(joined: DataFrame) -> DataFrame:
        scored = joined.withColumn("score", F.round(F.col("tf") * idf, 9))
        return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    least = 0
    if salt and salt > 1:
        tf_s = tf.withColumn("_salt", F.pmod(F.hash("doc"), F.lit(salt)))
        df_s = dfreq.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        ranked = top(tf_s.join(df_s, ["term", "_salt"]).drop("_salt"))
    elif (least := _common_from(dfreq)) <= 1:
        ranked = top(tf.join(F.broadcast(dfreq), "term"))
    else:
        common = F.broadcast(dfreq.filter(F.col("df") >= least))
        rare = tf.join(common.select("term"), "term", "left_anti").join(dfreq.filter(F.col("df") < least), "term")
        ranked = top(top(tf.join(common, "term")).select("term", "doc", "tf", "df")
                     .unionByName(rare.select("term", "doc", "tf", "df")))
    return ranked.select(F.col("doc").alias(id_col), "rank", "term", "tf", "df", "score")


def _common_from(dfreq: DataFrame) -> int:
    """The least power of two that at most :data:`BROADCAST_TERMS` document
    frequencies reach. Counts by powers of two reach the driver."""
    sizes = {r["e"]: r["n"] for r in dfreq.groupBy(F.floor(F.log2("df")).alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = 0
    for e in sorted(sizes, reverse=True):
        total += sizes[e]
        if total > BROADCAST_TERMS:
            return 2 ** (e + 1)
    return 0


def keyword_tags(terms: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, tags)`` with the terms in rank order (at most k per id)."""
    return (terms.groupBy(id_col)
                 .agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_r"))
                 .select(id_col, F.transform("_r", lambda x: x["term"]).alias("tags")))
