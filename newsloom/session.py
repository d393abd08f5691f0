"""Session helpers: a tuned builder for local runs and the lineage-cut location."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session we build gets. AQE re-plans joins and coalesces
# partitions from runtime statistics; skew-join splitting handles hot keys in
# sort-merge joins.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Noting the Python call site of every expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "newsloom",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir`` (or the one already set on the context). Only
    when neither is set (local tests) do we choose a folder of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no context on this client: the server-side setting applies
        return path or ""
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="newsloom-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives a lost
    executor, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def task_parallelism(spark: SparkSession) -> int:
    """Number of task slots the cluster offers (at least 1)."""
    try:
        return max(1, spark.sparkContext.defaultParallelism)
    except Exception:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a *scan* enough partitions for the per-row work that follows.

    A Parquet file with a single row group loads as one partition; at cluster
    scale inputs already arrive in many splits and this is a no-op, so the
    round-robin shuffle is only paid when the input is too coarse. Call it on
    a bare scan only: for a plan with shuffles, asking for the partition
    count makes adaptive execution run those shuffles first. After a shuffle
    no call is needed (AQE keeps at least the default parallelism).
    """
    want = min_partitions or task_parallelism(df.sparkSession)
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # sessions without RDD access: leave partitioning to Spark
        return df
    if have < want:
        return df.repartition(want)
    return df


