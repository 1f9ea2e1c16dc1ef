"""A record of finished work: which (kind, id, digest) are done and in which batch of output they are.

A batch writes its rows to a folder of its own and then one file of manifest rows. Only that makes it count: readers take the
folders that the manifest names, and what a broken run left is neither read nor taken for done. A row whose content changed has
another digest and is work again; of its outputs the last one counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .sinks import table_exists

MANIFEST = "kind string, id string, digest string, batch string, at timestamp"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], MANIFEST)


def digest_of(columns: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def pending(df: DataFrame, manifest: str, kind: str, key: str, columns: list[str]) -> DataFrame:
    """df's rows, with their digest of these columns, that the manifest doesn't have under this kind. Rows without a key are
    left out."""
    done = read_manifest(df.sparkSession, manifest).where(F.col("kind") == kind).select(F.col("id").alias("__id"), F.col("digest").alias("__digest"))
    rows = df.where(F.col(key).isNotNull()).withColumn("digest", digest_of(columns))
    return rows.join(done.distinct(), (F.col(key).cast("string") == F.col("__id")) & (F.col("digest") == F.col("__digest")), "left_anti")


def process(df: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, manifest: str, kind: str, key: str, columns: list[str]) -> int:
    """Runs work over the pending rows (it keeps key and digest) as one batch and records it; returns how many rows it wrote."""
    spark, batch, seen = df.sparkSession, uuid.uuid4().hex, Observation()
    rows = work(pending(df, manifest, kind, key, columns)).observe(seen, F.count(F.lit(1)).alias("n"))
    rows.write.parquet(f"{out}/batch={batch}")
    if not seen.get["n"]:
        return 0
    done = spark.read.schema(rows.schema).parquet(f"{out}/batch={batch}").select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), "digest", F.lit(batch).alias("batch"), F.current_timestamp().alias("at"))
    done.distinct().write.mode("append").parquet(manifest)
    return seen.get["n"]


def finished(spark: SparkSession, out: str, manifest: str, kind: str, key: str, schema: str) -> DataFrame:
    """The rows of recorded batches: of each key those of its last batch."""
    done = read_manifest(spark, manifest).where(F.col("kind") == kind)
    last = done.groupBy("id").agg(F.max_by("batch", F.struct("at", "batch")).alias("batch"))
    rows = spark.read.schema(f"{schema}, batch string").parquet(out) if table_exists(spark, out) else spark.createDataFrame([], f"{schema}, batch string")
    return rows.join(last, (rows["batch"] == last["batch"]) & (rows[key].cast("string") == last["id"]), "left_semi").drop("batch")
