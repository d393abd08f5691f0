"""Document frequencies kept from run to run, and the log of model answers."""

import datetime as dt
import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsloom.operators import keywords as KW
from newsloom.operators.enrich import ModelResults
from newsloom.operators.term_state import TermState
from newsloom.plans import enrich as EN
from newsloom.schema import ARTICLE_SCHEMA
from newsloom.sources.store import ArticleTable
from tests.test_pruning import parsed_rows

NOW = dt.datetime(2026, 12, 1, 6)
PAGES = "url string, html string, fetched_at timestamp_ntz"


def article(i):
    return (f"id{i}", f"Title {i}", f"u{i}", "src", None, None, None, None, None, NOW, NOW, False)


def page(i, text, hour):
    return (f"u{i}", f"<p>{text}</p>", NOW + dt.timedelta(hours=hour))


def recount(pages):
    texts = EN.page_texts(pages).filter("text <> ''")
    return {r.term: r.df for r in KW.document_frequencies(texts).collect()}, texts.count()


def kept(state):
    return {r.term: r.df for r in state.frequencies().collect()}, state.documents()


def test_frequencies_equal_a_recount_after_refetches(spark, scratch):
    state = TermState(spark, "ts_recount", scratch + "/s")
    store = ArticleTable(spark, "ts_articles", scratch + "/t", parts=4)
    store.append(spark.createDataFrame([article(i) for i in range(6)], ARTICLE_SCHEMA))
    landed = [[page(i, f"common word{chr(97 + i)} again", 0) for i in range(4)] + [page(9, "", 0)],
              [page(1, "changed entirely", 1), page(4, "common newcomer", 1), page(9, "filled now", 1)],
              [page(1, "", 2), page(4, "common newcomer", 2), page(5, "last one", 2), page(0, "older fetch", -5)],
              []]
    parses, seen = [], []
    for rows in landed:
        seen += rows
        pages = spark.createDataFrame(seen, PAGES)
        before = store.pending().select("url").collect()
        latest = EN.latest_fetches(pages)
        want = {r.url for r in state.uncounted(latest).collect()} | ({r.url for r in before} & {r.url for r in latest.collect()})
        texts = EN.page_texts(EN.rows_with_keys(pages, latest.filter(F.col("url").isin(sorted(want))), ["url", "fetched_at"]))
        parses.append((parsed_rows(texts), len(want)))
        counts = {r.outcome: r["count"] for r in EN.run_enrich(store, pages, NOW, state=state).collect()}
        assert kept(state) == recount(pages)
        assert sum(counts.values()) == len(before)
    # Only fetches not counted yet and pages of pending articles are parsed.
    assert parses == [(5, 5), (3, 3), (3, 3), (0, 0)]
    state.compact()
    assert kept(state) == recount(spark.createDataFrame(seen, PAGES))
    assert state.uncounted(EN.latest_fetches(spark.createDataFrame(seen, PAGES))).count() == 0


def test_tags_equal_those_of_a_full_count(spark, scratch):
    rows = [article(i) for i in range(8)]
    pages = spark.createDataFrame([page(i, f"about again another {'zebra ' * (i % 3)} crossing{chr(97 + i)}", 0) for i in range(8)], PAGES)
    a = spark.createDataFrame(rows, ARTICLE_SCHEMA)
    state = TermState(spark, "ts_tags", scratch + "/s")
    EN.enrich_new(a.filter("id < 'id3'"), pages.filter("url < 'u5'"), state)
    got = {r.id: r.tags for r in EN.enrich_new(a, pages, state).updates.collect()}
    assert got == {r.id: r.tags for r in EN.enrich(a, pages).updates.collect()}


def test_counting_summarises_nothing(spark, scratch, monkeypatch):
    state = TermState(spark, "ts_count", scratch + "/s")
    pages = spark.createDataFrame([page(0, "common worda", 0), page(1, "common", 0), page(1, "changed", 1)], PAGES)
    monkeypatch.setattr(EN, "enrich_texts", None)
    for some in (pages.filter("fetched_at = timestamp_ntz'2026-12-01 06:00:00'"), pages):
        EN.count_fetches(some, state)
        assert kept(state) == recount(some)


def test_run_that_stopped_after_its_log_is_finished(spark, scratch, monkeypatch):
    state = TermState(spark, "ts_stop", scratch + "/s")
    texts = spark.createDataFrame([("u1", NOW, "alpha beta"), ("u2", NOW, "beta")], "url string, fetched_at timestamp_ntz, text string")
    real = TermState._write_changes
    monkeypatch.setattr(TermState, "_write_changes", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.count(texts)
    monkeypatch.setattr(TermState, "_write_changes", real)
    assert state.uncounted(texts.select("url", "fetched_at")).count() == 0
    state.settle()
    state.settle()
    assert kept(state) == ({"alpha": 1, "beta": 2}, 2)


def _model(folder, dies=None):
    """Counts its calls in files; dies once on one article."""
    def make():
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            for i in pdf["id"]:
                if i == dies and not os.path.exists(f"{folder}/died"):
                    open(f"{folder}/died", "w").close()
                    os._exit(1)
                open(f"{folder}/{i}-{len(glob.glob(f'{folder}/{i}-*'))}", "w").close()
            return pd.DataFrame({"id": pdf["id"], "summary": "S " + pdf["id"], "tag_text": "a, b"})
        return run
    return make


def calls(folder):
    out = {}
    for f in glob.glob(folder + "/*-*"):
        i = os.path.basename(f).split("-")[0]
        out[i] = out.get(i, 0) + 1
    return out


def test_answers_survive_a_killed_task(spark, scratch):
    """A task that dies midway stops the run; the next one asks for what is
    missing only, and a changed text is asked again."""
    store = ArticleTable(spark, "ts_model", scratch + "/t", parts=4)
    store.append(spark.createDataFrame([article(i) for i in range(40)], ARTICLE_SCHEMA))
    pages = spark.createDataFrame([page(i, f"text {i}", 0) for i in range(40)], PAGES)
    results = ModelResults(spark, "ts_answers", scratch + "/answers")
    os.makedirs(scratch + "/calls")
    make = _model(scratch + "/calls", "id7")
    asked = spark.createDataFrame([(f"id{i}", f"text{i}") for i in range(40)], "id string, text string")
    with pytest.raises(Exception):
        results.complete(asked, make, rows_at_a_time=5)
    done = {r.id for r in spark.table("ts_answers").collect()}
    first = calls(scratch + "/calls")
    assert done and len(done) < 40
    counts = {r.outcome: r["count"] for r in EN.run_enrich(store, pages, NOW, make, results=results).collect()}
    assert counts == {"updated": 40}
    again = calls(scratch + "/calls")
    assert set(again) == {f"id{i}" for i in range(40)} and all(again[i] == 1 for i in done)
    # A rerun over answered texts asks nothing; a changed text is asked again.
    got = results.complete(asked, make).collect()
    assert len(got) == 40 and calls(scratch + "/calls") == again and {tuple(r.tags) for r in got} == {("a", "b")}
    results.complete(asked.filter("id = 'id3'").withColumn("text", F.lit("other")), make)
    assert calls(scratch + "/calls")["id3"] == again["id3"] + 1 and first
