"""Tables in the folder that all executors share: state kept between runs and results that several
later reads take up."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below `spark.checkpoint.dir`.

    Only a local session that names none (a test, a laptop) gets a temporary one; on a cluster a
    machine-local folder would be lost with its machine, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="shopgauge-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str) -> DataFrame:
    """The frame written to the shared folder once and read back."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Most bytes that a task reads while state is brought up to date. Keys and counts of a shuffle or a
# file take ten times their stored size and more in a task that sorts or counts them.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
              "spark.sql.files.maxPartitionBytes": 16 << 20}


def _bytes(size: str) -> int:
    digits, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(digits) << 10 * "_kmgtp".index(unit or "_")


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs inside run in tasks of at most TASK_BYTES; a smaller setting of the session stays."""
    before = {k: spark.conf.get(k) for k in TASK_BYTES}
    try:
        for k, most in TASK_BYTES.items():
            if _bytes(before[k]) > most:
                spark.conf.set(k, str(most))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
