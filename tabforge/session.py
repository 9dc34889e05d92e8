"""Session helpers: a tuned local/cluster session and a lineage-cutting checkpoint folder.

On a cluster the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir`` (a shared filesystem); without one nothing is written.
Only a local master (tests, the bench) gets a fresh scratch folder instead.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a part from which it pays to move them.
SPREAD_ROWS = 10_000


#: Settings for wide rows: the JVM never compiles a method over 8,000 bytes of bytecode, so a plan that would
#: need one is better split into many small methods.
TUNED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> None:
    """Set :data:`TUNED` in a running session, where the caller has not set them."""
    for name, value in TUNED.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def get_spark(app: str = "tabforge", cores: str | int | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """A tuned session.  A master that is already configured (spark-submit, a running
    session) is kept; only without one does the session run as ``local[cores]``."""
    builder = SparkSession.builder
    local = False
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if SparkSession.getActiveSession() is None and not submitted:
        builder = builder.master(f"local[{cores or os.environ.get('BENCH_CPUS') or '*'}]")
        local = True
    builder = (
        builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if local:   # a cluster's own memory and shuffle settings are kept
        builder = builder.config("spark.driver.memory", "20g").config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a local master without one gets a scratch folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    path = path or current
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tabforge-ckpt-", dir="/tmp")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments lock core settings; the context setting suffices
            pass
    if not current:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: later reads prune columns and partitions.

    The partition columns come last.
    """
    path = scratch_path(df.sparkSession, name)
    df = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A large table that comes in fewer than two parts a core, in even parts by ``key``; any other as it is."""
    parts = 2 * df.sparkSession.sparkContext.defaultParallelism
    if df.count() < SPREAD_ROWS * parts or df.rdd.getNumPartitions() >= parts:
        return df
    return df.repartition(parts, key)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
