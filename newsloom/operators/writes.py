"""Write-path operators: row contract, first-wins dedupe, insert-if-absent,
keyed update and run counters.

All are plain DataFrame plans; :mod:`newsloom.sources.store` persists them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import schema as S
from newsloom.functions.times import ntz


def article_id(url: Column) -> Column:
    """Stable id from the url, so a rerun produces the same id."""
    return F.sha2(url, 256)


def contract_reason(title: str = "title", url: str = "url", source: str = "source") -> Column:
    """First violated rule of the article row contract, NULL when the row is
    acceptable."""
    t, u, s = F.col(title), F.col(url), F.col(source)
    return (F.when(t.isNull(), F.lit("title_missing"))
             .when(u.isNull() | (u == F.lit("")), F.lit("url_missing"))
             .when(s.isNull(), F.lit("source_missing"))
             .when(F.char_length(t) > S.TITLE_MAX_CHARS, F.lit("title_too_long"))
             .when(F.char_length(s) > S.SOURCE_MAX_CHARS, F.lit("source_too_long")))


def apply_contract(df: DataFrame, now: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). A violating row goes to ``rejected`` with a
    ``reason``; the rest continue. Accepted rows get the table defaults:
    ``id`` from the url, ``created_at``/``updated_at`` = ``now``,
    ``metadata_generated`` = FALSE."""
    tagged = df.withColumn("reason", contract_reason())
    ok = tagged.filter(F.col("reason").isNull()).drop("reason")
    stamp = ntz(now)
    defaults = {
        "id": article_id(F.col("url")),
        "created_at": stamp,
        "updated_at": stamp,
        "metadata_generated": F.lit(False),
    }
    for name, value in defaults.items():
        if name in ok.columns:
            ok = ok.withColumn(name, F.coalesce(F.col(name), value))
        else:
            ok = ok.withColumn(name, value)
    return ok, tagged.filter(F.col("reason").isNotNull())


def first_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """Keep, per key, the row that comes first in ``order`` (ascending).

    Implemented as ``min(struct(order..., rest...))`` grouped by key rather
    than ``row_number`` over a window: the aggregate combines map-side, so a
    key that holds a large share of the rows is reduced in every task before
    the shuffle instead of landing whole in one task. Remaining columns break
    ties, so the choice is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return df.groupBy(*keys).agg(packed).select(*keys, "_first.*").select(*df.columns)


#: Keys that a semi-join hands to every executor: at most so many, of so many
#: characters together.
BROADCAST_KEYS, BROADCAST_CHARS = 200_000, 16_000_000


def rows_with_keys(df: DataFrame, keys: DataFrame, on: list[str], counted: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns occur in ``keys`` (a null first key
    occurs nowhere, other nulls are equal).
    ``keys`` is read twice, so it should be cheap or written down: it is
    measured first and broadcast if it is small, so that wide rows of ``df``
    stay where they are; beyond that both sides are shuffled. ``counted``: rows
    that hold every key at least once and are cheaper to measure than ``keys``."""
    chars = sum((F.coalesce(F.char_length(F.col(c).cast("string")), F.lit(0)) for c in on), F.lit(0))
    # Sums of the tasks: no row of the keys leaves its task to be counted.
    head = (keys if counted is None else counted).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars")).first()
    small = head["n"] <= BROADCAST_KEYS and head["chars"] <= BROADCAST_CHARS
    k = keys.select(*[F.col(c).alias(f"_key_{c}") for c in on])
    same = [df[on[0]] == F.col(f"_key_{on[0]}"), *[df[c].eqNullSafe(F.col(f"_key_{c}")) for c in on[1:]]]
    match = same[0]
    for more in same[1:]:
        match = match & more
    return df.join(F.broadcast(k) if small else k, match, "left_semi")


def insert_if_absent(existing: DataFrame, batch: DataFrame, key: str = "url",
                     *, order: list[str]) -> DataFrame:
    """Rows of ``batch`` to append: first occurrence per key inside the batch
    in ``order``, and only keys not already in ``existing`` (first writer
    wins across runs). Only the key column of ``existing`` is read."""
    firsts = first_per_key(batch, key, order)
    return firsts.join(known_keys(existing, firsts, key), key, "left_anti")


def known_keys(existing: DataFrame, batch: DataFrame, key: str = "url") -> DataFrame:
    """Keys of ``batch`` that ``existing`` has. The batch is the small side of
    this semi-join: adaptive execution broadcasts its keys where they are
    few, so the table's keys are neither shuffled nor made distinct; the
    result has at most one row per key of a unique ``batch`` and table."""
    return existing.select(key).join(batch.select(key), key, "left_semi")


def insert_outcomes(existing: DataFrame, batch: DataFrame, key: str = "url",
                    *, order: list[str]) -> DataFrame:
    """Each batch row labelled ``inserted`` (it is the first for its key and
    the key is new) or ``conflict`` (an earlier row or the table already has
    the key), as the reference counts attempts."""
    # The key-only join runs on one row per key (after first_per_key), so a
    # hot key never meets the table side in bulk; the join back to the batch
    # is on (key, order...), which identifies single rows.
    firsts = first_per_key(batch.select(key, *order), key, order)
    firsts = (firsts.join(known_keys(existing, firsts, key), key, "left_anti")
              .withColumn("_new", F.lit(True)))
    labelled = batch.join(firsts, [key, *order], "left")
    return labelled.withColumn(
        "outcome",
        F.when(F.coalesce(F.col("_new"), F.lit(False)), F.lit(S.OUTCOME_INSERTED))
         .otherwise(F.lit(S.OUTCOME_CONFLICT))).drop("_new")


def outcome_counts(df: DataFrame, col: str = "outcome") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def run_counters(outcomes: DataFrame) -> DataFrame:
    """One row of a collect run's counters: ``attempted`` (entries that
    reached the insert), ``inserted``, ``conflicts`` and ``skipped``."""
    n = lambda *names: F.count(F.when(F.col("outcome").isin(*names), 1))
    return outcomes.agg(
        n(S.OUTCOME_INSERTED, S.OUTCOME_CONFLICT).alias("attempted"), n(S.OUTCOME_INSERTED).alias("inserted"),
        n(S.OUTCOME_CONFLICT).alias("conflicts"),
        n(S.OUTCOME_REJECTED, S.OUTCOME_UNREACHABLE, S.OUTCOME_NO_LINK).alias("skipped"))


def update_by_key(existing: DataFrame, updates: DataFrame, key: str = "id",
                  now: _dt.datetime | None = None, mark: dict[str, Column] | None = None,
                  order: list[str] | None = None) -> DataFrame:
    """Keyed update: for rows whose key appears in ``updates``, take every
    column present in ``updates`` (even NULL or an empty array), set ``mark``
    columns (default ``metadata_generated = TRUE``) and stamp ``updated_at``
    with ``now``; other rows are unchanged. Where ``updates`` has a key more
    than once, the row that comes first in ``order`` (then by the remaining
    columns) counts, so a table row is never multiplied.
    """
    updates = first_per_key(updates, key, list(order or ()))
    set_cols = [c for c in updates.columns if c != key and c not in (order or ())]
    mark = {"metadata_generated": F.lit(True)} if mark is None else mark
    u = updates.select(F.col(key), F.lit(True).alias("_matched"),
                       *[F.col(c).alias(f"_new_{c}") for c in set_cols])
    j = existing.join(u, key, "left")
    hit = F.coalesce(F.col("_matched"), F.lit(False))
    out = []
    for c in existing.columns:
        if c in set_cols:
            out.append(F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        elif c in mark:
            out.append(F.when(hit, mark[c]).otherwise(F.col(c)).alias(c))
        elif c == "updated_at" and now is not None:
            out.append(F.when(hit, ntz(now)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
