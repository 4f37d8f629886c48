"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on: UTC wall time for
# timestamp_ntz arithmetic, ANSI casts, AQE for runtime re-planning (coalescing,
# skew splitting, broadcast only when the runtime size is under the threshold).
#
# The two broadcast limits bound different things. Before a run Spark knows of a
# table only the size of its compressed file: 7 million part keys and names are 26 MB
# there, 290 MB as rows and twice that as the hash table the driver builds. So a
# join is planned as a broadcast by FILE_BROADCAST_BYTES, and otherwise left to
# AQE, which broadcasts a side once its rows have been counted in bytes. Rows take
# two to three times their bytes in the driver, and a query that builds many tables
# (missing_tables, 13 broadcasts) holds them at once.
FILE_BROADCAST_BYTES = 2 * 1024 * 1024
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(FILE_BROADCAST_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


# Of these, the ones that decide results rather than speed.
RESULT_CONF = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.sources.partitionOverwriteMode",
               "spark.sql.parquet.outputTimestampType")

# Sizing for the target deployment (about 100 TB of sources on ~1000 executors).
# Shuffles start fine-grained and AQE coalesces them to ~256 MB partitions, so
# the same job fits both a small month and a full backfill; skewed join
# partitions above 5x the median are split; scans read 256 MB splits; a
# dimension is broadcast only while its rows, measured at run time, stay under
# 64 MB, otherwise the join stays a shuffled join.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(FILE_BROADCAST_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = 8,
                  app: str = "ledgerwright", extra: dict | None = None) -> SparkSession:
    """A session; with ``master`` None its master and sizes are those of spark-submit."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("LW_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply the session settings to a session someone else built (the driver's).

    ``cluster=True`` also applies :data:`CLUSTER_CONF`; it is left off for local
    runs, whose partition counts the caller chose. Settings that decide results
    always hold; sizes that the session was started with are left as they are.
    """
    conf = {**SESSION_CONF, **(CLUSTER_CONF if cluster else {})}
    started = spark.sparkContext.getConf()
    for k, v in conf.items():
        sized = k in CLUSTER_CONF and not cluster and spark.conf.get(k, None) == CLUSTER_CONF[k]
        if k.startswith("spark.sql.") and not sized and (k in RESULT_CONF or not started.contains(k)):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written tables.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    without it there is none, which is an error. Only in a local session (tests) a
    fresh scratch folder is created and set.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.removeprefix("file:")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lw-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local
