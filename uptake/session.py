"""Session helpers: a local session for tests/bench, and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall-clock timestamps, ANSI arithmetic,
# adaptive execution (runtime broadcast conversion, skew-join splitting,
# partition coalescing, splitting heavy partitions of rebalanced writes) and
# parquet aggregate pushdown for MIN/MAX/COUNT.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot user's rows are split even where that costs another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "uptake") -> SparkSession:
    """A local session for tests and the bench (UI off, no server ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("UPTAKE_DRIVER_MEMORY", "8g"))
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The cluster's ``spark.checkpoint.dir`` wins. Only a local-mode session
    (tests, the bench) may fall back to a fresh scratch folder; on a cluster a
    machine-local folder would vanish with its executor, so we refuse.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if not current:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder (HDFS/object store)")
    local = tempfile.mkdtemp(prefix="uptake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def materialize(df: DataFrame, name: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder.

    Unlike ``localCheckpoint`` the data lives in shared storage, so a lost
    executor does not lose it. Used between the cleaning stage and the metric
    stage of batch jobs; the registered queries stay lazy end to end.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name or 'df'}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
