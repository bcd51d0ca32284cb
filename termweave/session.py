"""Session helpers: build a session with sane defaults and find the shared checkpoint
folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "termweave",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return the active session or build one.  On a cluster pass ``master=None`` and
    let the submit configuration decide; locally ``master='local[8]'``."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only when
    neither is set and the master is local -- tests -- a folder is created under
    ``fallback`` (or a fresh temporary folder) and registered.  On a cluster a machine's
    own folder would lose data, so a missing setting is an error there."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = fallback or tempfile.mkdtemp(prefix="termweave-ckpt-")
    os.makedirs(d, exist_ok=True)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/termweave/{tag}-{uuid.uuid4().hex}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 executor_memory_gb: int) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume (pass them to the
    session builder or ``spark-submit --conf``).

    * Text work is CPU-heavy per byte (several regex passes per document), so input
      splits are kept at 64 MB rather than 128 MB: more, shorter tasks and less
      straggling on long documents.
    * The initial shuffle partition count is one per GB of input (shuffles here carry
      a fraction of the input: partial aggregates, sentences after filtering), at
      least three per core and at most 50,000 so map-output tracking stays manageable;
      AQE then coalesces toward the advisory size and splits skewed join partitions, so
      one hot key cannot pin a task.
    * Auto-broadcast stays at Spark's default size; every explicit broadcast in this
      package is behind a row-count check or a bound known by construction.
    """
    cores = executors * cores_per_executor
    per_partition = 128 * 1024 * 1024
    shuffle = min(50_000, max(3 * cores, int(input_bytes // 2**30) + 1))
    return {
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(per_partition),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.executor.memory": f"{executor_memory_gb}g",
        "spark.executor.cores": str(cores_per_executor),
        "spark.task.maxFailures": "8",
    }
