"""Tables between steps: written to the folder that driver and executors share, so that a lost executor costs nothing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster names it; where it is unset (tests on one machine), a temporary one for the session."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{key} isn't set: driver and executors need a folder that they share")
        found = "file://" + tempfile.mkdtemp(prefix="tamarack-shared-")
        spark.conf.set(key, found)
    return found.rstrip("/")


def fresh(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def settled(df: DataFrame, tag: str) -> DataFrame:
    """df, written and read back: it isn't computed again, and its plan begins here."""
    path = fresh(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
