"""Session helper.

The master is never forced: on a cluster it comes from spark-submit, in tests from the caller.
The setting that decides results (UTC) is pinned; results do not depend on ANSI mode (the oracle
tool checks both), and sizing settings are left to the cluster unless the caller passes them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that every run of this library relies on.
BASE_CONF = {
    # Day buckets and unix seconds must not depend on the JVM's zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # switch to broadcast only when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "shopgauge",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in BASE_CONF.items():
        if k != "spark.ui.enabled":
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in `spark.checkpoint.dir`.

    A machine-local folder would be lost with its machine, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current
