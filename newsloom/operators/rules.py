"""Ordered source-name rules, delete-by-predicate and their counts.

The reference runs one SQL UPDATE per rule, each seeing the previous result.
Here the rules fold into columns of a single projection: one scan, no
shuffle, and per-rule hit counts come from one global aggregate (partial
sums per task, so no key can concentrate work).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.times import ntz


@dataclass(frozen=True)
class Rule:
    pos: int
    target: str
    like_pattern: str
    exclude: str | None = None


# Fixed values that must equal the reference maintenance scripts.
# Default set: sources deleted first, then LIKE rules in this order.
DEFAULT_DELETE = ("マイナビニュース", "Semiconductor Today", "Semiconductor-today")
DEFAULT_RULES = (
    Rule(1, "ITmedia", "ITmedia%", "ITmedia"),
    Rule(2, "マイナビ Tech+", "マイナビ%", "マイナビ Tech+"),
    Rule(3, "マイナビ Tech+", "TECH+%", None),
    Rule(4, "日経XTECH", "日経%", "日経XTECH"),
)
# Variant set of the SQL script: no delete step, TECH+ goes to 日経XTECH, last.
SQL_VARIANT_RULES = (
    Rule(1, "ITmedia", "ITmedia%", "ITmedia"),
    Rule(2, "マイナビ Tech+", "マイナビ%", "マイナビ Tech+"),
    Rule(3, "日経XTECH", "日経%", "日経XTECH"),
    Rule(4, "日経XTECH", "TECH+%", None),
)
# Sources the duplicate clean-up deletes.
CLEANUP_SOURCES = (
    "ITmedia エグゼクティブ",
    "ITmedia エンタープライズ",
    "ITmedia ビジネスオンライン",
    "ITmedia Mobile",
    "ITmedia NEWS",
    "ITmedia PC USER",
)


def rules_from(table) -> list[Rule]:
    """The rules (configuration: a list of :class:`Rule`) sorted by ``pos``."""
    return sorted(table, key=lambda r: r.pos)


def rule_hit(cur: Column, rule: Rule) -> Column:
    """``cur LIKE pattern [AND cur <> exclude]``; NULL never hits."""
    pred = cur.like(rule.like_pattern)
    if rule.exclude is not None:
        pred = pred & (cur != F.lit(rule.exclude))
    return F.coalesce(pred, F.lit(False))


def delete_where(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """Rows kept (a NULL predicate keeps the row, as SQL DELETE does) and a
    one-row count of rows deleted."""
    hit = F.coalesce(pred, F.lit(False))
    kept = df.filter(~hit)
    counts = df.agg(F.sum(hit.cast("long")).alias("deleted"),
                    F.sum((~hit).cast("long")).alias("kept"))
    return kept, counts.fillna(0)


def flag_rules(df: DataFrame, rules, delete: tuple[str, ...] | list[str] = (),
               col: str = "source") -> DataFrame:
    """Add ``_del`` (row removed by the delete list), ``_hit_<i>`` per rule
    (evaluated on the value left by the rules before it) and ``_new`` (final
    value). Each step is its own projection so no expression is repeated."""
    rules = rules_from(rules)
    out = df.withColumn("_del", F.coalesce(F.col(col).isin(list(delete)), F.lit(False))
                        if delete else F.lit(False))
    out = out.withColumn("_new", F.col(col))
    for i, r in enumerate(rules):
        hit = f"_hit_{i}"
        out = out.withColumn(hit, ~F.col("_del") & rule_hit(F.col("_new"), r))
        out = out.withColumn("_new", F.when(F.col(hit), F.lit(r.target)).otherwise(F.col("_new")))
    return out


def _hit_cols(flagged: DataFrame) -> list[str]:
    return [c for c in flagged.columns if c.startswith("_hit_")]


def apply_flags(flagged: DataFrame, now: _dt.datetime | None = None,
                col: str = "source", stamp: str = "updated_at") -> DataFrame:
    """Final table: deleted rows removed, new values in place, ``updated_at``
    set to ``now`` on every row some rule touched (even if the value did not
    change), untouched rows keep theirs."""
    hits = _hit_cols(flagged)
    touched = reduce(lambda a, b: a | b, [F.col(h) for h in hits], F.lit(False))
    out = flagged.filter(~F.col("_del")).withColumn(col, F.col("_new"))
    if now is not None and stamp in flagged.columns:
        out = out.withColumn(stamp, F.when(touched, ntz(now))
                             .otherwise(F.col(stamp)))
    return out.drop("_del", "_new", *hits)


def step_counts(flagged: DataFrame, rules, delete=(), col: str = "source", weight: str | None = None) -> DataFrame:
    """Rows affected per step: ``(step, kind, match, target, rows)``; one
    aggregate pass, unpivoted on the one-row result. ``weight``: a column
    with the number of rows a row of ``flagged`` stands for."""
    rules = rules_from(rules)
    n = F.col(weight) if weight else F.lit(1).cast("long")
    rows = lambda hit: F.sum(F.when(hit, n).otherwise(0))
    aggs = [rows(F.col("_del") & (F.col(col) == F.lit(s))).alias(f"d{i}") for i, s in enumerate(delete)]
    aggs += [rows(F.col(f"_hit_{i}")).alias(f"h{i}") for i in range(len(rules))]
    one = flagged.agg(*aggs) if aggs else flagged.agg(F.count(F.lit(1)).alias("_n"))
    parts = []
    for i, s in enumerate(delete):
        parts.append(F.struct(F.lit(i + 1).alias("step"), F.lit("delete").alias("kind"),
                              F.lit(s).alias("match"), F.lit(None).cast("string").alias("target"),
                              F.coalesce(F.col(f"d{i}"), F.lit(0)).alias("rows")))
    for i, r in enumerate(rules):
        parts.append(F.struct(F.lit(len(delete) + i + 1).alias("step"), F.lit("rule").alias("kind"),
                              F.lit(r.like_pattern).alias("match"), F.lit(r.target).alias("target"),
                              F.coalesce(F.col(f"h{i}"), F.lit(0)).alias("rows")))
    if not parts:
        return one.limit(0)
    return one.select(F.inline(F.array(*parts)))


def normalise_sources(df: DataFrame, rules=DEFAULT_RULES, delete=DEFAULT_DELETE,
                      now: _dt.datetime | None = None,
                      col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(new table, per-step counts). Persist or write ``flagged`` once if both
    outputs are consumed, to scan the input once."""
    flagged = flag_rules(df, rules, delete, col)
    return apply_flags(flagged, now, col), step_counts(flagged, rules, delete, col)
