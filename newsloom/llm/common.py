"""Helpers shared by the operators: lineage cuts, running sums over a global
order, and connected components. All of them stay distributed; the driver
only ever sees counters."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import cut_lineage, ensure_checkpoint_dir

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: the plan is cut and the rows
    survive a lost executor."""
    return cut_lineage(df)


def release_unused() -> None:
    """At a task's end: Arrow returns the memory of its batches, which it would
    keep while the Python worker waits for the next task."""
    pa.default_memory_pool().release_unused()


def shared_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: a lineage
    cut for wide tables that are read more than once, by columns."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Ids that a semi-join broadcasts at most (8 bytes each); beyond that both
#: sides are shuffled.
BROADCAST_IDS = 2_000_000


def rows_named(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids`` (one materialised column of
    the same name). The ids are counted first: only up to ``BROADCAST_IDS``
    they are broadcast, so that the texts that stay out don't move."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, by: Sequence[str] = (),
               out: str = "cum") -> DataFrame:
    """Inclusive running sum of ``value`` in the order of ``order`` (within
    each combination of ``by``), without a window over a whole group.

    Rows are range-partitioned by ``by`` and ``order``, each range is summed
    on its own, and the sums of the earlier ranges (one row per range and
    ``by`` combination that occurs in it) are added. A hot ``by`` value is
    spread over as many ranges as its rows need. ``order`` should identify a
    row; rows that tie on all of it get a sum in an arbitrary but repeatable
    order among equal rows. The placed rows are checkpointed, so a recomputed
    range can't shift the offsets.
    """
    by, order = list(by), list(order)
    placed = materialise(
        df.repartitionByRange(shuffle_partitions(df), *by, *order)
          .withColumn("_pid", F.spark_partition_id()))
    totals = placed.groupBy(*by, "_pid").agg(F.sum(value).alias("_total"))
    earlier = (Window.partitionBy(*by).orderBy("_pid")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
                            F.col("_pid").alias("_opid"),
                            F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    match = F.col("_pid") == F.col("_opid")
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    within = (Window.partitionBy("_pid", *by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("_run", F.sum(value).over(within))
                  .join(offsets, match, "left")
                  .withColumn(out, F.col("_run") + F.col("_offset"))
                  .drop("_pid", "_opid", "_total", "_offset", "_run",
                        *[f"_by{i}" for i in range(len(by))]))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): one row
    (id, component) per vertex, component being the smallest id reachable.

    Minimum labels travel along the edges and are then shortened by looking
    up the label's own label, so long chains take logarithmically many
    rounds. Every round is aggregated by vertex (map-side minimum first, so
    a vertex with very many edges is no single group) and checkpointed; the
    driver sees the number of changed labels only.
    """
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct())
    labels = materialise(both.groupBy(F.col("a").alias("id"))
                         .agg(F.min("b").alias("nb"))
                         .select("id", F.least("id", "nb").alias("component")))
    while True:
        seen = (both.join(labels.select(F.col("id").alias("a"), "component"), "a")
                    .groupBy(F.col("b").alias("id")).agg(F.min("component").alias("near")))
        lower = labels.join(seen, "id", "left").select(
            "id", F.col("component").alias("old"),
            F.least("component", F.coalesce("near", "component")).alias("component"))
        own = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        step = materialise(lower.join(own, "component", "left").select(
            "id", "old", F.least("component", F.coalesce("up", "component")).alias("component")))
        changed = step.filter("old <> component").limit(1).count()
        labels = step.select("id", "component")
        if not changed:
            return labels
