"""Session settings and the shared work folder.

The settings are the ones every operator here relies on:

* UTC session time zone, so ``timestamp_ntz`` values, dates and the
  DuckDB oracle agree;
* AQE on, with partition coalescing and skew-join splitting, so a hot
  key on either side of a sort-merge join is split at run time and a
  join side that turns out small is broadcast from measured sizes;
* broadcast joins only below Spark's size threshold (checked by the
  planner from statistics and again by AQE from shuffle sizes), with a
  sort-merge join beyond it;
* no UI server.

Tables live in the session's warehouse.  Landed files and stream
checkpoints lie below the shared folder of :func:`checkpoint_dir`; a session
without one is refused, since a folder of one machine would lose rows on a
cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for ~100 TB on a large cluster (pass as ``extra=``):
# start with many shuffle partitions and let AQE coalesce them towards
# ~256 MB; split only partitions that are really large; read 256 MB splits.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1GB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kestrel", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a
    cluster leave them ``None`` and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session."""
    for key, value in DEFAULT_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the one that the application has
    set, else ``spark.checkpoint.dir``.  It is an error if there is none."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return current.rstrip("/")


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the shared checkpoint folder, for one job's files."""
    return f"{checkpoint_dir(spark)}/kestrel-work/{name or 'job'}-{uuid.uuid4().hex[:12]}"
