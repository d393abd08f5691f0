"""Incremental collect and enrich.

Collect: a file stream over the landing folder (only files not seen by the
checkpoint are read), ``trigger(availableNow=True)`` so a scheduled run
processes what has landed and stops, and ``foreachBatch`` applying the
collect plan against the store. First-wins across runs comes from the
anti-join on ``url`` against what earlier batches appended, which also makes
a replayed batch (after a failure between append and commit) a no-op.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.plans import collect as C
from newsloom.sources import feeds as FD


def collect_stream(spark: SparkSession, landing: str, store, catalogue: DataFrame,
                   pages: Callable[[], DataFrame], now: Callable[[], _dt.datetime],
                   ref_date: Callable[[], _dt.date], checkpoint: str,
                   counts_sink: Callable[[DataFrame, int], None] | None = None,
                   max_files: int | None = 1000, max_bytes: str | None = None):
    """Start the incremental collect; returns the ``StreamingQuery``
    (``awaitTermination()`` waits for the available files to finish).
    ``pages``/``now``/``ref_date`` are called per batch so each batch sees
    the landed pages and the job time of its run. ``checkpoint`` is the
    stream's own folder: two streams must not share one, and the next run
    must find it again. A micro-batch takes at most ``max_files`` feed files,
    or files of ``max_bytes`` together (one of the two), so a backlog is worked
    off in batches of bounded size; the stream stops when it has caught up."""
    if (max_files is None) == (max_bytes is None):
        raise ValueError("give max_files or max_bytes")
    bound = {"maxFilesPerTrigger": max_files} if max_bytes is None else {"maxBytesPerTrigger": max_bytes}
    stream = (spark.readStream.format("text").option("wholetext", True).options(**bound)
              .option("pathGlobFilter", "*.xml").load(landing)
              .select(F.col("_metadata.file_name").alias("file_name"), "value"))

    def batch(df: DataFrame, epoch: int) -> None:
        landed = FD.from_files(df)
        counts = C.run_collect(store, catalogue, landed, pages(), now(), ref_date())
        if counts_sink is not None:
            counts_sink(counts, epoch)

    return (stream.writeStream.foreachBatch(batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
