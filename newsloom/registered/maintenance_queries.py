"""Source maintenance queries over the raw-source corpus."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from newsloom.checkout import sql_ts
from newsloom.operators import facets, rules as R
from newsloom.plans import maintenance
from newsloom.registered.base import ARTICLES_CTE
from newsloom.registry import register
from newsloom.sources.tables import RAW_SOURCE_NAMES, source_corpus

NOW = _dt.datetime(2026, 12, 1, 6, 0, 0)
_NOW_SQL = "TIMESTAMP '2026-12-01 06:00:00'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NAMES_SQL = "[" + ", ".join(_q(n) for n in RAW_SOURCE_NAMES) + "]"
CORPUS_CTE = (
    "corpus AS (SELECT * REPLACE ("
    f"{_NAMES_SQL}[CAST(substr(id, 3, 12) AS BIGINT) % {len(RAW_SOURCE_NAMES)} + 1] AS source)"
    " FROM articles)")


def corpus_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([ARTICLES_CTE, CORPUS_CTE, *ctes]) + "\n" + body


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _rules_sql(rules, delete) -> tuple[list[str], str]:
    """Sequential-update emulation: CTE s0 (after delete) .. sN, each rule a
    CASE over the previous step, with its hit flag kept."""
    ctes = []
    where = f"WHERE NOT coalesce(source IN {_in(delete)}, false)" if delete else ""
    ctes.append(f"s0 AS (SELECT id, updated_at, source AS cur, false AS touched FROM corpus {where})")
    for i, r in enumerate(R.rules_from(list(rules)), start=1):
        cond = f"cur LIKE {_q(r.like_pattern)}"
        if r.exclude is not None:
            cond += f" AND cur <> {_q(r.exclude)}"
        cond = f"coalesce({cond}, false)"
        prev = [f"h{j}" for j in range(1, i)]
        keep = "".join(f", {p}" for p in prev)
        ctes.append(
            f"s{i} AS (SELECT id, updated_at{keep}, {cond} AS h{i}, "
            f"CASE WHEN {cond} THEN {_q(r.target)} ELSE cur END AS cur, "
            f"touched OR {cond} AS touched FROM s{i - 1})")
    return ctes, f"s{len(rules)}"


def _hist_sql(rules, delete) -> str:
    ctes, last = _rules_sql(rules, delete)
    return corpus_sql(f"SELECT cur AS source, count(*) AS count FROM {last} GROUP BY cur", *ctes)


def _counts_sql(rules, delete) -> str:
    ctes, last = _rules_sql(rules, delete)
    rules = R.rules_from(list(rules))
    parts = []
    for i, s in enumerate(delete, start=1):
        parts.append(f"SELECT {i} AS step, 'delete' AS kind, {_q(s)} AS match, "
                     f"CAST(NULL AS VARCHAR) AS target, "
                     f"(SELECT count(*) FROM corpus WHERE source = {_q(s)}) AS rows")
    for i, r in enumerate(rules, start=1):
        parts.append(f"SELECT {len(delete) + i} AS step, 'rule' AS kind, {_q(r.like_pattern)} AS match, "
                     f"{_q(r.target)} AS target, "
                     f"(SELECT count(*) FROM {last} WHERE h{i}) AS rows")
    return corpus_sql(" UNION ALL ".join(parts), *ctes)


@register("a1_source_counts_desc", corpus_sql(
    "SELECT source, count(*) AS count FROM corpus GROUP BY source"))
def a1_source_counts_desc(spark, sf):
    return facets.source_counts(source_corpus(spark, sf), "count")


@register("a2_source_counts", corpus_sql(
    "SELECT source, count(*) AS count FROM corpus GROUP BY source"))
def a2_source_counts(spark, sf):
    return facets.source_counts(source_corpus(spark, sf), "source")


@register("a3_delete_preview", corpus_sql(
    f"SELECT source, count(*) AS count FROM corpus WHERE source IN {_in(R.CLEANUP_SOURCES)} "
    "GROUP BY source"))
def a3_delete_preview(spark, sf):
    return maintenance.delete_preview(source_corpus(spark, sf))


@register("a4_counts_with_total", corpus_sql(
    "SELECT source, count(*) AS count, false AS is_total FROM corpus GROUP BY source "
    "UNION ALL SELECT NULL, count(*), true FROM corpus"))
def a4_counts_with_total(spark, sf):
    return facets.source_counts_with_total(source_corpus(spark, sf))


@register("s6_delete_count", corpus_sql(
    f"SELECT count(*) FILTER (WHERE source IN {_in(R.CLEANUP_SOURCES)}) AS deleted, "
    f"count(*) FILTER (WHERE NOT coalesce(source IN {_in(R.CLEANUP_SOURCES)}, false)) AS kept "
    "FROM corpus"))
def s6_delete_count(spark, sf):
    _, counts = R.delete_where(source_corpus(spark, sf),
                               F.col("source").isin(list(R.CLEANUP_SOURCES)))
    return counts


@register("n1_normalised_histogram", _hist_sql(R.DEFAULT_RULES, R.DEFAULT_DELETE))
def n1_normalised_histogram(spark, sf):
    table, _ = maintenance.normalise(source_corpus(spark, sf), "default", NOW)
    return facets.source_counts(table, "count")


@register("a7_rule_hits", _counts_sql(R.DEFAULT_RULES, R.DEFAULT_DELETE))
def a7_rule_hits(spark, sf):
    _, counts = maintenance.normalise(source_corpus(spark, sf), "default", NOW)
    return counts


@register("n2_normalised_histogram", _hist_sql(R.SQL_VARIANT_RULES, ()))
def n2_normalised_histogram(spark, sf):
    table, _ = maintenance.normalise(source_corpus(spark, sf), "sql", NOW)
    return facets.source_counts(table, "count")


@register("n2_rule_hits", _counts_sql(R.SQL_VARIANT_RULES, ()))
def n2_rule_hits(spark, sf):
    _, counts = maintenance.normalise(source_corpus(spark, sf), "sql", NOW)
    return counts


def _s8_sql() -> str:
    ctes, last = _rules_sql(R.DEFAULT_RULES, R.DEFAULT_DELETE)
    return corpus_sql(
        f"SELECT id, cur AS source, {sql_ts(f'CASE WHEN touched THEN {_NOW_SQL} ELSE updated_at END')} "
        f"AS updated_at FROM {last}", *ctes)


@register("s8_restamp", _s8_sql())
def s8_restamp(spark, sf):
    """After normalisation: every touched row carries the job time."""
    table, _ = maintenance.normalise(source_corpus(spark, sf), "default", NOW)
    return table.select("id", "source", "updated_at")


@register("n3_cleanup_after", corpus_sql(
    "SELECT source, count(*) AS count FROM corpus "
    f"WHERE NOT coalesce(source IN {_in(R.CLEANUP_SOURCES)}, false) GROUP BY source"))
def n3_cleanup_after(spark, sf):
    """Preview, delete when the preview found rows, recount."""
    return maintenance.cleanup(source_corpus(spark, sf)).after
