"""Collect: landed feeds + landed pages -> new article rows and outcomes.

catalogue -> entries -> link check -> default title -> reachability (narrow
columns of the landed pages) -> row contract -> first per url in catalogue
order -> insert if absent -> page fields of the new urls only (parsed on the
page scan) -> date / image.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom import schema as S
from newsloom.functions.times import ntz
from newsloom.operators import writes
from newsloom.schema import ARTICLE_COLUMNS
from newsloom.session import cut_lineage
from newsloom.sources import feeds as FD
from newsloom.sources import pages as P

ORDER = ["run_id", "source_pos", "feed_pos", "entry_pos"]


@dataclass
class CollectResult:
    outcomes: DataFrame  # one row per entry, with the article columns when accepted

    @property
    def rows(self) -> DataFrame:
        """Article rows to append (ARTICLE_SCHEMA columns)."""
        return article_rows(self.outcomes)


def page_fields(pages: DataFrame, ref_date, states: DataFrame | None = None) -> DataFrame:
    """Per url, the fields of its latest landed fetch: ``url, published_day,
    bad_date, image_url``, and without ``states`` also ``reachable,
    page_reason``. Pages are parsed where they are read and only the extracted
    fields are shuffled; a fetch that failed is not parsed. ``states``
    (:func:`pages.fetch_states`): only the fetches that it names are parsed,
    and only urls that answered have a row."""
    when = [c for c in ("fetched_at",) if c in pages.columns]
    fields = ["published_day", "bad_date", "image_url"]
    if states is not None:
        parsed = P.extract_fields(P.with_page_fields(P.pages_to_parse(pages, states)), ref_date)
        return P.latest_fetch(parsed.select("url", *when, *fields)).select("url", *fields)
    ok = pages.withColumn("html", F.when(P.fetch_ok(), F.col("html")))
    parsed = P.extract_fields(P.with_page_fields(ok), ref_date)
    last = P.latest_fetch(parsed.select("url", *when, "http_status", "fetch_error", *fields))
    reason = P.reject_reason()
    return (last.withColumn("_has_page", F.lit(True)).withColumn("page_reason", reason)
            .select("url", F.col("page_reason").isNull().alias("reachable"), "page_reason", *fields))


def collect(catalogue: DataFrame, landed_feeds: DataFrame, pages: DataFrame,
            existing: DataFrame, now: _dt.datetime, ref_date: _dt.date,
            materialise: bool = True) -> CollectResult:
    """Label every feed entry with one outcome: ``rejected`` (unknown or
    unreadable feed / contract), ``no_link``, ``unreachable``, ``conflict``
    or ``inserted``. ``existing`` holds the table's urls.

    The work follows what is new: of the landed pages, the narrow columns are
    semi-joined with the batch's links; of the acceptable entries the first per
    url is chosen and urls that the table has are marked; only the pages of
    the new urls are parsed. What is known of a url is one row, which meets
    the entries once. Published day and image are those of inserted rows, null
    in others.

    With ``materialise`` (default) the entries of the batch and the row of each
    url are written to the shared checkpoint folder, as several steps read
    them; they hold links and titles, no page."""
    keep = cut_lineage if materialise else (lambda df: df)
    cat = catalogue.select("feed_key", "source", "source_pos", "feed_pos", F.lit(True).alias("_known_feed"))
    # No broadcast hint: a catalogue built from configuration is tiny and AQE
    # broadcasts it after measuring it, while a catalogue derived from data
    # (one feed per site) may grow with the data and then stays a shuffle join.
    ent = keep(FD.entries(landed_feeds).join(cat, "feed_key", "left").select(
        "feed_key", *ORDER, "source", "feed_ok", "_known_feed",
        F.when(F.col("feed_ok") & FD.has_link(), F.col("link")).alias("url"), FD.title_or_default().alias("title")))
    # Entries without a url have nothing to join; together they would be one
    # hot key.
    linked, bare = ent.filter(F.col("url").isNotNull()), ent.filter(F.col("url").isNull())

    # One row per url: its first acceptable entry (combined in every task
    # before the shuffle), the state of its page, and whether the table has it.
    sound = F.col("_known_feed") & F.col("feed_ok") & writes.contract_reason().isNull()
    urls = linked.groupBy("url").agg(F.min(F.when(sound, F.struct(*ORDER))).alias("_first"))
    states = P.fetch_states(pages, urls.select("url"), counted=linked.select("url"))
    known = writes.known_keys(existing, urls.filter(F.col("_first").isNotNull())).distinct().withColumn("_known", F.lit(True))
    new = F.col("_first").isNotNull() & F.coalesce("reachable", F.lit(False)) & F.col("_known").isNull()
    gate = keep(urls.join(states, "url", "left").join(known, "url", "left").withColumn("_new", new).drop("_known"))

    # The pages of the new urls, then back to the entries, on the url alone.
    info = page_fields(pages, ref_date, gate.filter("_new"))
    found = gate.select("url", "reachable", "page_reason", "_first", "_new").join(info, "url", "left")
    reason = (F.when(F.col("_known_feed").isNull(), F.lit("unknown_feed"))
               .when(~F.col("feed_ok"), F.lit("bad_feed"))
               .when(F.col("url").isNull(), F.lit("no_link"))
               .when(F.col("reachable").isNull(), F.lit("no_page"))
               .when(~F.col("reachable"), F.col("page_reason"))
               .otherwise(writes.contract_reason()))
    stage = (F.when(F.col("_known_feed").isNull() | ~F.col("feed_ok"), F.lit(S.OUTCOME_REJECTED))
              .when(F.col("url").isNull(), F.lit(S.OUTCOME_NO_LINK))
              .when(~F.coalesce("reachable", F.lit(False)), F.lit(S.OUTCOME_UNREACHABLE))
              .when(F.col("reason").isNotNull(), F.lit(S.OUTCOME_REJECTED)))
    inserted = F.col("_new")
    for c in ORDER:
        inserted = inserted & (F.col(c) == F.col("_first")[c])
    labelled = (linked.join(found, "url", "left").unionByName(bare, allowMissingColumns=True)
                .withColumn("reason", reason)
                .withColumn("outcome", F.coalesce(stage, F.when(inserted, F.lit(S.OUTCOME_INSERTED)), F.lit(S.OUTCOME_CONFLICT)))
                .withColumns({c: F.when(F.col("outcome") == S.OUTCOME_INSERTED, F.col(c))
                              for c in ("published_day", "bad_date", "image_url")}))
    stamp = ntz(now)
    out = labelled.select(
        "feed_key", "run_id", "source_pos", "feed_pos", "entry_pos", "outcome", "reason",
        F.coalesce(F.col("bad_date"), F.lit(False)).alias("bad_date"),
        writes.article_id(F.col("url")).alias("id"), "title", "url", "source", "image_url",
        F.lit(None).cast("string").alias("content"), F.col("published_day").cast("timestamp_ntz").alias("published_date"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("array<string>").alias("tags"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
        F.lit(False).alias("metadata_generated"))
    return CollectResult(out)


def article_rows(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == S.OUTCOME_INSERTED).select(*ARTICLE_COLUMNS)


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return writes.outcome_counts(outcomes)


def run_collect(store, catalogue: DataFrame, landed_feeds: DataFrame, pages: DataFrame,
                now: _dt.datetime, ref_date: _dt.date) -> DataFrame:
    """Collect into an :class:`~newsloom.sources.store.ArticleTable`, whose
    bucketed urls the batch is checked against: materialise the labelled entries once (reliable checkpoint in the shared
    checkpoint folder), append the inserted rows, return outcome counts."""
    res = collect(catalogue, landed_feeds, pages, store.urls(), now, ref_date)
    labelled = cut_lineage(res.outcomes)
    new = article_rows(labelled)
    if not new.isEmpty():
        store.append(new)
    return outcome_counts(labelled)
