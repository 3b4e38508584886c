"""Helpers shared by the operators of this subpackage: tables, words, shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of code points outside these six.
WHITE_SPACE = "\t\n\x0b\x0c\r "
_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAK), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Only a session in local mode that names none
    (a test, a laptop) gets a temporary one; on a cluster a machine-local folder would not be
    seen by other executors, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="shopgauge-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/shopgauge-{what}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, what: str, **options: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts lineage: later jobs read files that outlive any executor, and the planner knows the
    table's size, so that it broadcasts it only below its threshold.
    """
    path = scratch(df.sparkSession, what)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
