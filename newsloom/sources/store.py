"""The article table as Spark tables behind one view.

Rows are partitioned by ``state`` (pending / done) and the month of
``published_date``, and sorted on it in the files, so the worklist, a day, a
date range and an enrich run read (and an update rewrites) the partitions
they need and no others. Narrow tables go with them: the urls, bucketed and
sorted on ``url``, against which a batch is anti-joined without moving the
table's side; the number of rows by day, source and tag, as signed changes of
every run, from which a listing page knows its date range and the facets are
read; and, for an ``indexed`` table, the postings of
:mod:`newsloom.operators.postings`, bucketed by gram.

The view names the current version. :meth:`ArticleTable.replace` writes a new
version beside it and then points the view there, one catalog statement; the
version before stays until the next one. Steps that touch several tables note
what they do in a table property first; whoever writes next finishes it, and
readers take it into account, so a stopped job leaves no wrong rows. Spark's
own writers commit everything. One writer at a time is assumed, as for
scheduled jobs.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators import postings as PO
from newsloom.operators import writes
from newsloom.schema import ARTICLE_COLUMNS, ARTICLE_SCHEMA
from newsloom.session import cut_lineage

PENDING, DONE = "pending", "done"
UNDATED = "none"
_PLACE = ["state", "month"]
_NOTE = "newsloom.step"
_VERSION = "newsloom.version"


def month_of(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def _labelled(values: Column, kind: str) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))


class ArticleTable:
    """``name`` in the session catalog; ``path`` for a folder outside the
    warehouse; ``parts`` buckets of the url table and the postings, fixed for
    a version; ``indexed``: keep postings for :func:`search.stored_search`."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, parts: int = 64, indexed: bool = False):
        self.spark, self.name, self.parts, self.indexed = spark, name, parts, indexed
        self._within = ""
        if path:
            self._within = f"{name}_tables."
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}_tables LOCATION '{path}'")
        if not spark.catalog.tableExists(name):
            self._create(1)
            self._point(1)

    # -- versions ---------------------------------------------------------
    def _tables(self, version: int) -> tuple[str, str, str, str]:
        base = f"{self._within}{self.name}_v{version}"
        return base, f"{base}_urls", f"{base}_counts", f"{base}_grams"

    def _side(self, which: int) -> DataFrame:
        t = self._tables(self._version())[which]
        self.spark.catalog.refreshTable(t)
        return self.spark.table(t)

    def _version(self) -> int:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return int({r["key"]: r["value"] for r in rows}[_VERSION])

    def _create(self, version: int) -> None:
        rows, urls, counts, grams = self._tables(version)
        for t in (rows, urls, counts, grams):
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        empty = self.spark.createDataFrame([], ARTICLE_SCHEMA)
        self._placed(empty).write.format("parquet").partitionBy(*_PLACE).saveAsTable(rows)
        empty.select("url").write.format("parquet").bucketBy(self.parts, "url").sortBy("url").saveAsTable(urls)
        self._counts(empty).write.format("parquet").saveAsTable(counts)
        if self.indexed:
            (PO.postings(self._placed(empty)).write.format("parquet").bucketBy(self.parts, "gram").sortBy("gram", "id").saveAsTable(grams))

    def _point(self, version: int) -> None:
        columns = ", ".join([*ARTICLE_COLUMNS, *_PLACE])
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('{_VERSION}' = '{version}') AS "
                       f"SELECT {columns} FROM {self._tables(version)[0]}")

    def _note(self, step: dict | None) -> None:
        t = self._tables(self._version())[0]
        self.spark.sql(f"ALTER TABLE {t} UNSET TBLPROPERTIES IF EXISTS ('{_NOTE}')" if step is None else
                       f"ALTER TABLE {t} SET TBLPROPERTIES ('{_NOTE}' = '{json.dumps(step)}')")

    def _noted(self) -> dict | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._tables(self._version())[0]}").collect()
        found = {r["key"]: r["value"] for r in rows}.get(_NOTE)
        return json.loads(found) if found else None

    # -- layout -----------------------------------------------------------
    @staticmethod
    def _placed(rows: DataFrame) -> DataFrame:
        waiting = F.coalesce(~F.col("metadata_generated"), F.lit(False))
        return rows.select(*ARTICLE_COLUMNS).withColumns({
            "state": F.when(waiting, PENDING).otherwise(DONE), "month": month_of(F.col("published_date"))})

    @staticmethod
    def _clustered(placed: DataFrame) -> DataFrame:
        """Files of disjoint date ranges within a partition, sorted: a month
        with many rows becomes several files, not one task."""
        order = [*_PLACE, "published_date", "id"]
        return placed.repartitionByRange(*order).sortWithinPartitions(*order)

    @staticmethod
    def _counts(rows: DataFrame, kinds: tuple[str, ...] = ("day", "source", "tag"), sign: int = 1) -> DataFrame:
        """``(kind, value, n)``: rows by published day, by source and by tag
        (one a tag and row)."""
        tags = F.array_distinct(F.coalesce("tags", F.array().cast("array<string>")))
        found = {"day": F.array(F.date_format("published_date", "yyyy-MM-dd")), "source": F.array("source"), "tag": tags}
        values = F.flatten(F.array(*[_labelled(found[k], k) for k in kinds]))
        return (rows.select(F.explode(values).alias("v")).groupBy("v.kind", "v.value")
                .agg((F.count(F.lit(1)) * sign).alias("n")))

    def _physical(self) -> DataFrame:
        t = self._tables(self._version())[0]
        self.spark.catalog.refreshTable(t)
        return self.spark.table(t)

    # -- reading ----------------------------------------------------------
    def _rows(self) -> DataFrame:
        """All rows with their place. While rows move from pending to done,
        those that have arrived count."""
        rows, step = self._physical(), self._noted()
        if not step or step["step"] != "move":
            return rows
        moving = (F.col("state") == PENDING) & F.col("month").isin(step["months"])
        arrived = rows.filter((F.col("state") == DONE) & F.col("month").isin(step["months"])).select("id")
        return rows.filter(~moving).unionByName(rows.filter(moving).join(arrived, "id", "left_anti"))

    def read(self) -> DataFrame:
        """The rows as last written, by whichever session."""
        return self._rows().select(*ARTICLE_COLUMNS)

    def pending(self) -> DataFrame:
        """Rows that wait for their metadata: only their partitions are read."""
        return self._rows().filter(F.col("state") == PENDING).select(*ARTICLE_COLUMNS)

    def between(self, first: _dt.date | None, last: _dt.date | None, undated: bool = False) -> DataFrame:
        """Rows published from ``first`` to ``last`` (inclusive, None: open),
        with ``undated`` also those without a date. Months are pruned as
        partitions, files and row groups by the pushed bounds."""
        month, date = F.col("month"), F.col("published_date")
        here = month != UNDATED
        if first is not None:
            here = here & (month >= first.strftime("%Y-%m")) & (date >= F.lit(f"{first} 00:00:00").cast("timestamp_ntz"))
        if last is not None:
            end = last + _dt.timedelta(days=1)
            here = here & (month <= last.strftime("%Y-%m")) & (date < F.lit(f"{end} 00:00:00").cast("timestamp_ntz"))
        return self._rows().filter((here | (month == UNDATED)) if undated else here).select(*ARTICLE_COLUMNS)

    def undated(self) -> DataFrame:
        """Rows without a published date."""
        return self._rows().filter(F.col("month") == UNDATED).select(*ARTICLE_COLUMNS)

    def urls(self) -> DataFrame:
        """``url`` of every row, bucketed: a join on it moves the other side."""
        return self._side(1)

    def counts(self, kind: str) -> DataFrame:
        """``(value, n)``: rows by ``day``, ``source`` or ``tag`` now, summed
        over the runs' changes; the table itself is not read."""
        return (self._side(2).filter(F.col("kind") == kind).groupBy("value").agg(F.sum("n").alias("n")).filter("n > 0"))

    def days(self) -> DataFrame:
        """``(day, n)``: rows by published day, null for undated ones."""
        return self.counts("day").select(F.col("value").cast("date").alias("day"), "n")

    def postings(self) -> DataFrame:
        """``(gram, field, id, month)`` of an indexed table."""
        if not self.indexed:
            raise ValueError(f"{self.name} is kept without postings")
        return self._side(3)

    def named(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` (``id, month``; written down): only their months'
        partitions are read. Names of months reach the driver."""
        months = [r["month"] for r in keys.select("month").distinct().collect()]
        rows = self._rows().filter(F.col("month").isin(months))
        return writes.rows_with_keys(rows, keys.select("id"), ["id"]).select(*ARTICLE_COLUMNS)

    def day_range(self, limit: int, offset: int = 0, after: _dt.date | None = None) -> dict | None:
        """Of the listing (newest day first, undated rows last), the days that
        hold its rows ``offset`` to ``offset + limit``: ``first, last,
        undated, skip`` (rows of the range before the page). ``after``: the
        page follows a cursor on that day, whose rows come on top. None when
        the listing ends before. One row reaches the driver."""
        newest = Window.orderBy(F.col("day").desc_nulls_last())
        days = self.days()
        if after is not None:
            days = days.filter(F.col("day").isNull() | (F.col("day") <= F.lit(after)))
            # Rows of the cursor's own day may all be before it.
            days = days.withColumn("n", F.when(F.col("day") == F.lit(after), 0).otherwise(F.col("n")))
        run = days.withColumn("end", F.sum("n").over(newest)).withColumn("start", F.col("end") - F.col("n"))
        need = (F.col("start") < offset + limit) & (F.col("end") > offset) if after is None else F.col("start") < limit
        hit = run.filter(need).agg(F.min("day").alias("first"), F.max("day").alias("last"), F.min("start").alias("start"),
                                   F.count(F.when(F.col("day").isNull(), 1)).alias("undated"), F.count(F.lit(1)).alias("n")).first()
        if not hit["n"]:
            return None
        return {"first": hit["first"], "last": hit["last"], "undated": hit["undated"] > 0, "skip": offset - hit["start"] if after is None else 0}

    # -- writing ----------------------------------------------------------
    def append(self, rows: DataFrame) -> None:
        """Insert new rows; ``rows`` is read several times. Rows, then urls
        and counts: a job that stops in between leaves a note."""
        self.settle()
        self._note({"step": "append"})
        self._insert(rows, self._version())
        self._note(None)

    def _insert(self, rows: DataFrame, version: int) -> None:
        t, urls, counts, grams = self._tables(version)
        placed = self._placed(rows)
        self._clustered(placed).write.insertInto(t)
        self._insert_urls(rows.select("url"), urls)
        self._counts(rows).coalesce(1).write.insertInto(counts)
        if self.indexed:
            self._insert_postings(PO.postings(placed), grams)

    def _insert_postings(self, postings: DataFrame, table: str) -> None:
        postings.repartition(self.parts, "gram").sortWithinPartitions("gram", "id").write.insertInto(table)

    def _insert_urls(self, urls: DataFrame, table: str) -> None:
        # The writer's buckets are the shuffle's: one file a bucket and run.
        urls.repartition(self.parts, "url").sortWithinPartitions("url").write.insertInto(table)

    def update(self, updates: DataFrame, now: _dt.datetime, pending_only: bool = False) -> None:
        """Keyed update (:func:`writes.update_by_key`) that marks its rows
        done. Only partitions with an updated row are rewritten; rows that
        were pending are added to their month's done files, which are not read
        for it. ``pending_only``: updated rows are pending ones, so only those
        partitions are looked at. Names of the touched partitions reach the
        driver."""
        if "published_date" in updates.columns:
            raise ValueError("an update can't move rows to another month")
        self.settle()
        rows = self._physical()
        if pending_only:
            rows = rows.filter(F.col("state") == PENDING)
        touched = [(r["state"], r["month"]) for r in
                   rows.join(updates.select("id"), "id", "left_semi").select(*_PLACE).distinct().collect()]
        if not touched:
            return
        here = lambda: F.struct(*_PLACE).isin([F.struct(F.lit(s).alias("state"), F.lit(m).alias("month")) for s, m in touched])
        # Plain comparisons on the partition columns, so that partitions are pruned.
        by_state = {s: [m for t, m in touched if t == s] for s, _ in touched}
        old = rows.filter(F.lit(False))
        for state, months in by_state.items():
            old = old.unionByName(rows.filter((F.col("state") == state) & F.col("month").isin(months)))
        new = cut_lineage(self._placed(writes.update_by_key(old.select(*ARTICLE_COLUMNS), updates, "id", now)))
        # What the facets gain and lose: counts of the updated rows, after and before.
        hit = lambda df: df.join(updates.select("id"), "id", "left_semi")
        change = cut_lineage(self._counts(hit(new), ("source", "tag")).unionByName(
            self._counts(hit(old), ("source", "tag"), -1)).groupBy("kind", "value").agg(F.sum("n").alias("n")).filter("n <> 0"))
        t, _, counts, grams = self._tables(self._version())
        self._note({"step": "move", "months": by_state.get(PENDING, [])})
        self._clustered(new.filter(~here())).write.insertInto(t)
        stay = new.filter(here())
        self._overwrite(self._clustered(stay), t)
        left = {(r["state"], r["month"]) for r in stay.select(*_PLACE).distinct().collect()}
        for state, month in set(touched) - left:
            self.spark.sql(f"ALTER TABLE {t} DROP IF EXISTS PARTITION (state='{state}', month='{month}')")
        change.coalesce(1).write.insertInto(counts)
        if self.indexed and {"tags", "title"} & set(updates.columns):
            fields = [f for f, c in ((PO.TITLE, "title"), (PO.TAG, "tags")) if c in updates.columns]
            self._insert_postings(PO.postings(hit(new), fields=tuple(fields)), grams)
        self._note(None)

    def _recount(self) -> None:
        """Make the side tables anew from the rows: counts, and postings."""
        _, _, counts, grams = self._tables(self._version())
        rows = self._physical()
        self._counts(rows).coalesce(1).write.insertInto(counts, overwrite=True)
        if self.indexed:
            PO.postings(rows).repartition(self.parts, "gram").sortWithinPartitions("gram", "id").write.insertInto(grams, overwrite=True)

    def _overwrite(self, placed: DataFrame, table: str) -> None:
        # Only the session setting reaches an insert into a catalog table.
        conf, mode = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            placed.write.insertInto(table, overwrite=True)
        finally:
            conf.set(mode, before)

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows``, usually derived from :meth:`read`, the whole table:
        a new, newly clustered version, current from one statement on."""
        version = self._version()
        for t in self._tables(version - 1):
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self._create(version + 1)
        t, urls, counts, grams = self._tables(version + 1)
        self._clustered(self._placed(rows)).write.insertInto(t)
        self.spark.catalog.refreshTable(t)
        written = self.spark.table(t)
        self._insert_urls(written.select("url"), urls)
        self._counts(written).coalesce(1).write.insertInto(counts)
        if self.indexed:
            self._insert_postings(PO.postings(written), grams)
        self._point(version + 1)

    def settle(self) -> None:
        """Finish what a stopped writer noted. A move: pending rows that have
        arrived are taken out, counts and postings made anew from the rows. An
        append: all side tables are made anew, as a new version."""
        step = self._noted()
        if step is None:
            return
        if step["step"] == "append":
            self.replace(self._physical())
            return
        t = self._tables(self._version())[0]
        months = step["months"]
        left = cut_lineage(self._rows().filter((F.col("state") == PENDING) & F.col("month").isin(months))
                           .select(*ARTICLE_COLUMNS, *_PLACE))
        self._overwrite(self._clustered(left), t)
        have = {r["month"] for r in left.select("month").distinct().collect()}
        for month in set(months) - have:
            self.spark.sql(f"ALTER TABLE {t} DROP IF EXISTS PARTITION (state='{PENDING}', month='{month}')")
        self._recount()
        self._note(None)
