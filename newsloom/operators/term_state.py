"""Document frequencies kept from run to run.

Two tables grow by one partition a run: ``pages`` logs the fetches a run
counted, ``sign`` +1 with their distinct terms, and takes back earlier fetches
of the same urls, ``sign`` -1 with theirs; ``terms`` has the run's change of
every term's document frequency (of the number of documents under a null
term), which is the sum over the log's partition. Frequencies are sums of
changes, so runs merge in any order and a page that is fetched again is
corrected without reading the others.

The log is written first. A run that stops before its changes were written is
finished from the log by the next one, so no fetch is counted twice. One
writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import keywords as KW
from newsloom.operators.writes import rows_with_keys
from newsloom.session import cut_lineage

_LOG = "url string, fetched_at timestamp_ntz, sign int, terms array<string>, run long"
_CHANGES = "term string, delta long, run long"


class TermState:
    """``name``: prefix of the two tables in the session catalog; ``path``
    for a folder outside the warehouse."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None):
        self.spark, self._within = spark, ""
        if path:
            self._within = f"{name}_state."
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}_state LOCATION '{path}'")
        self.log_table, self.change_table = f"{self._within}{name}_pages", f"{self._within}{name}_terms"
        for table, schema in ((self.log_table, _LOG), (self.change_table, _CHANGES)):
            if not spark.catalog.tableExists(table):
                spark.createDataFrame([], schema).write.partitionBy("run").saveAsTable(table)

    def _read(self, table: str) -> DataFrame:
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)

    def _runs(self, table: str) -> set[int]:
        return {int(r[0].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def counted(self) -> DataFrame:
        """``(url, fetched_at)`` of the fetches that count now."""
        return (self._read(self.log_table).groupBy("url", "fetched_at").agg(F.sum("sign").alias("n"))
                .filter("n > 0").drop("n"))

    def uncounted(self, latest: DataFrame) -> DataFrame:
        """Rows of ``latest`` (``url, fetched_at``, one a url) that don't
        count yet."""
        have = self.counted().select(F.col("url").alias("_url"), F.col("fetched_at").alias("_at"))
        return latest.join(have, (F.col("url") == F.col("_url")) & F.col("fetched_at").eqNullSafe(F.col("_at")), "left_anti")

    def count(self, texts: DataFrame) -> None:
        """Count fetches (``url, fetched_at, text``; one a url, written down,
        none of them counted before) in place of earlier ones of their urls.
        A fetch without text is logged but no document."""
        self.settle()
        run = max(self._runs(self.log_table), default=0) + 1
        terms = F.when(F.coalesce(F.col("text") != "", F.lit(False)), F.array_distinct(KW.terms(F.col("text"))))
        plus = KW.composed(texts).select("url", "fetched_at", F.lit(1).alias("sign"), terms.alias("terms"))
        log = self._read(self.log_table)
        old = rows_with_keys(log, texts.select("url"), ["url"])
        # What a url has on balance: its one fetch that still counts.
        minus = (old.groupBy("url", "fetched_at").agg(F.sum("sign").alias("n"), F.max("terms").alias("terms"))
                 .filter("n > 0").select("url", "fetched_at", F.lit(-1).alias("sign"), "terms"))
        plus.unionByName(minus).withColumn("run", F.lit(run).cast("long")).write.insertInto(self.log_table)
        self._write_changes(run)

    def _write_changes(self, run: int) -> None:
        log = self._read(self.log_table).filter(F.col("run") == run)
        docs = log.filter("terms IS NOT NULL").agg(F.coalesce(F.sum("sign"), F.lit(0)).alias("delta")) \
            .select(F.lit(None).cast("string").alias("term"), "delta")
        terms = (log.select("sign", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("sign").alias("delta"))
                 .filter("delta <> 0").select("term", "delta"))
        terms.unionByName(docs).withColumn("run", F.lit(run).cast("long")).write.insertInto(self.change_table)

    def settle(self) -> None:
        """Write the changes of a run that stopped after its log."""
        done = max(self._runs(self.change_table), default=0)
        for run in sorted(r for r in self._runs(self.log_table) if r > done):
            self._write_changes(run)

    def frequencies(self, terms: DataFrame | None = None) -> DataFrame:
        """``(term, df)``; of ``terms`` only, if given (one column ``term``,
        written down)."""
        changes = self._read(self.change_table).filter("term IS NOT NULL")
        if terms is not None:
            changes = rows_with_keys(changes, terms, ["term"])
        return changes.groupBy("term").agg(F.sum("delta").alias("df")).filter("df > 0")

    def documents(self) -> int:
        return int(self._read(self.change_table).filter("term IS NULL").agg(F.coalesce(F.sum("delta"), F.lit(0)).alias("n")).first()["n"])

    def compact(self) -> None:
        """Merge all runs into the last one's partition: fetches that were
        taken back leave the log. Each table is replaced by one overwrite, and
        a stop between the two changes no sum."""
        self.settle()
        last = max(self._runs(self.log_table), default=0)
        if last == 0:
            return
        log, changes = self._read(self.log_table), self._read(self.change_table)
        now = cut_lineage(log.groupBy("url", "fetched_at").agg(F.sum("sign").cast("int").alias("sign"), F.max("terms").alias("terms"))
                          .filter("sign > 0").select("url", "fetched_at", "sign", "terms", F.lit(last).cast("long").alias("run")))
        sums = cut_lineage(changes.groupBy("term").agg(F.sum("delta").alias("delta"))
                           .select("term", "delta", F.lit(last).cast("long").alias("run")))
        now.write.insertInto(self.log_table, overwrite=True)
        sums.write.insertInto(self.change_table, overwrite=True)
