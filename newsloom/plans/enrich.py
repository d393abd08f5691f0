"""Enrich: pending articles -> page text -> summary and tags -> keyed update.

Skips (the row stays pending and is retried by the next run): no fetched
page, empty text after the whitespace squeeze, or no summary. An empty tag
list still counts as done.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom import schema as S
from newsloom.functions import text as X
from newsloom.functions.summary import extractive_summary
from newsloom.operators import enrich as E
from newsloom.operators import keywords as KW
from newsloom.operators import paging, search, writes
from newsloom.operators.writes import rows_with_keys
from newsloom.session import cut_lineage
from newsloom.sources import pages as P


@dataclass
class EnrichResult:
    updates: DataFrame   # (id, content, summary, tags) for rows to mark done
    outcomes: DataFrame  # (id, outcome, reason) for every pending row


def worklist(articles: DataFrame, limit: int | None = None) -> DataFrame:
    """Pending rows, newest insert first; ``limit`` optional (none by default)."""
    w = search.pending(articles).select("id", "title", "url", "created_at")
    if limit is not None:
        return paging.order(w, paging.worklist_keys()).limit(limit)
    return w


def page_texts(pages: DataFrame) -> DataFrame:
    """(url, fetched_at, text) of the latest of the fetches given, parsed on
    the page scan; blocks of the page are separated by line ends, so that
    words of different blocks don't run together."""
    parsed = P.with_page_fields(_dated(pages)).select("url", "fetched_at", F.col("page")["blocks"].alias("text"))
    return P.latest_fetch(parsed)


def _dated(pages: DataFrame) -> DataFrame:
    if "fetched_at" in pages.columns:
        return pages
    return pages.withColumn("fetched_at", F.lit(None).cast("timestamp_ntz"))


def latest_fetches(pages: DataFrame) -> DataFrame:
    """(url, fetched_at) of the latest fetch of every landed page; reads no
    html."""
    return _dated(pages).groupBy("url").agg(F.max("fetched_at").alias("fetched_at"))


def enrich(articles: DataFrame, pages: DataFrame, make_model=None, limit: int | None = None,
           k: int = 10, budget: int = 200) -> EnrichResult:
    """Enrich pending articles, with document frequencies counted over all of
    ``pages`` (:func:`run_enrich` keeps them instead). The parsed texts are
    written once to the shared checkpoint folder; they feed the pending rows
    and, all of them, the frequencies, which so don't depend on what else is
    pending."""
    texts = cut_lineage(page_texts(pages)) if make_model is None else \
        page_texts(rows_with_keys(_dated(pages), worklist(articles, limit).select("url"), ["url"]))

    def frequencies(_terms: DataFrame) -> tuple[DataFrame, int]:
        corpus = texts.filter("text <> ''")
        return KW.document_frequencies(corpus), corpus.count()

    return enrich_texts(worklist(articles, limit), texts, frequencies, make_model, k, budget)


def enrich_texts(work: DataFrame, texts: DataFrame, frequencies, make_model=None, k: int = 10, budget: int = 200,
                 results=None) -> EnrichResult:
    """Analysis reads the page text with its word and block breaks; the
    stored ``content`` is the squeezed text, as the reference stores it.

    Summary and topic words are found in the same projection as the text; only
    ids and terms are shuffled after it. ``frequencies``: from the worklist's
    terms (written down) to their ``(term, df)`` and the number of documents.
    A user model runs once per article: its results are written down before
    they are used, in ``results`` (:class:`ModelResults`) as they come, so that
    what a stopped run has paid for is not asked again."""
    own = work.join(texts.select("url", "text"), "url", "left").select("id", "title", "text", X.squeeze("text").alias("content"))
    has_text = F.coalesce(F.col("content") != F.lit(""), F.lit(False))
    if make_model is None:
        rows = cut_lineage(own.select(
            "id", "text", has_text.alias("_ok"),
            F.when(has_text, extractive_summary(F.col("text"), F.col("title"), budget)).alias("summary"),
            X.topic_hits(F.col("text")).alias("_topics")))
        tf = cut_lineage(KW.term_counts(rows.filter("_ok"), "id", "text"))
        dfreq, n_docs = frequencies(tf.select("term").distinct())
        tags = KW.keyword_tags(KW.top_terms(tf, cut_lineage(dfreq), n_docs, "id", k), "id")
    else:
        rows = cut_lineage(own.select("id", "text", has_text.alias("_ok"), X.topic_hits(F.col("text")).alias("_topics")))
        asked = rows.filter("_ok").select("id", X.squeeze("text").alias("text"))
        gen = results.complete(asked, make_model) if results is not None else cut_lineage(E.model_enrichment(asked, make_model))
        rows = rows.join(gen.select("id", "summary"), "id", "left")
        tags = gen.select("id", "tags")
    have = X.clean_tags(F.coalesce("tags", F.array().cast("array<string>")))
    updates = (rows.filter(F.col("_ok") & F.col("summary").isNotNull()).join(tags, "id", "left")
               .select("id", X.squeeze("text").alias("content"), "summary",
                       X.with_topics(have, F.col("_topics")).alias("tags")))
    reason = F.when(~F.col("_ok"), F.lit("no_text")).when(F.col("summary").isNull(), F.lit("no_summary"))
    outcomes = rows.select("id", F.when(reason.isNull(), F.lit(S.OUTCOME_UPDATED))
                           .otherwise(F.lit(S.OUTCOME_SKIPPED)).alias("outcome"), reason.alias("reason"))
    return EnrichResult(updates, outcomes)


def count_fetches(pages: DataFrame, state, work: DataFrame | None = None) -> DataFrame:
    """Count the landed fetches that ``state`` doesn't have yet. Returns the
    page texts of these and of the pages of ``work``, written down."""
    state.settle()
    latest = cut_lineage(latest_fetches(pages))
    fresh = cut_lineage(state.uncounted(latest))
    wanted = fresh if work is None else cut_lineage(
        fresh.unionByName(latest.join(work.select("url"), "url", "left_semi")).distinct())
    texts = cut_lineage(page_texts(rows_with_keys(_dated(pages), wanted, ["url", "fetched_at"])))
    new = texts if work is None else cut_lineage(texts.join(fresh.select("url"), "url", "left_semi"))
    if not new.isEmpty():
        state.count(new)
    return texts


def enrich_new(articles: DataFrame, pages: DataFrame, state, limit: int | None = None, k: int = 10,
               budget: int = 200) -> EnrichResult:
    """Enrich pending articles with the document frequencies of ``state``
    (:class:`TermState`), after counting the fetches it doesn't have yet. Of
    the landed pages, the html of those fetches and of the pending articles'
    pages is read and parsed, once; of all others only url and time. Tags equal
    those of :func:`enrich`."""
    work = worklist(articles, limit)
    texts = count_fetches(pages, state, work)
    return enrich_texts(work, texts, lambda terms: (state.frequencies(terms), state.documents()), None, k, budget)


def apply(articles: DataFrame, result: EnrichResult, now: _dt.datetime) -> DataFrame:
    """The table after the update: updated rows get content, summary, tags,
    ``metadata_generated`` TRUE and ``updated_at`` = ``now``."""
    return writes.update_by_key(articles, result.updates, "id", now)


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row of an enrich run's counters: ``pending`` rows worked on,
    ``updated`` ones, and those ``still_pending``."""
    done = F.count(F.when(F.col("outcome") == S.OUTCOME_UPDATED, 1))
    n = F.count(F.lit(1))
    return outcomes.agg(n.alias("pending"), done.alias("updated"), (n - done).alias("still_pending"))


def run_enrich(store, pages: DataFrame, now: _dt.datetime, make_model=None,
               limit: int | None = None, state=None, results=None) -> DataFrame:
    """Incremental enrich against an ArticleTable: only pending rows are
    worked; failures stay pending for the next run. Updates and outcomes are
    derived from the same written rows; only the pending partitions are read
    and, of those, the ones with an updated row rewritten. ``state`` keeps the
    document frequencies (without it they are counted anew), ``results`` the
    answers of a model. Returns outcome counts."""
    pending = store.pending()
    if make_model is not None and results is not None:
        work = worklist(pending, limit)
        res = enrich_texts(work, page_texts(rows_with_keys(_dated(pages), work.select("url"), ["url"])), None, make_model,
                           results=results)
    elif make_model is None and state is not None:
        res = enrich_new(pending, pages, state, limit)
    else:
        res = enrich(pending, pages, make_model, limit)
    counts = cut_lineage(writes.outcome_counts(res.outcomes))
    store.update(cut_lineage(res.updates), now, pending_only=True)
    return counts
