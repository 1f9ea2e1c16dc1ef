"""Writers. A table that is read is never overwritten in place: a new version is written and then swapped in."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import assert_unique, insert_only_new


def _path(spark: SparkSession, name: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def append_new(new: DataFrame, path: str, keys: list[str], order: list[Column] | None = None) -> int:
    """Appends the rows whose key the table lacks; returns how many, as observed by the write itself. A second run with the
    same rows appends none."""
    spark, seen = new.sparkSession, Observation()
    old = spark.read.schema(new.schema).parquet(path) if table_exists(spark, path) else new.where("false")
    insert_only_new(new, old, keys, order).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def replace(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Writes df beside the table, holds its keys against uniqueness and then takes the table's place."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(staged)
    if keys:
        assert_unique(spark.read.parquet(staged), keys)
    target, fs = _path(spark, path)
    source, _ = _path(spark, staged)
    old, _ = _path(spark, f"{staged}.old")
    had = fs.exists(target)
    # rename may report failure by its result alone; the old table goes only once the new one stands in its place
    if had and not fs.rename(target, old):
        raise OSError(f"{path} can't be moved aside; the new rows are in {staged}")
    if not fs.rename(source, target):
        if had and not fs.rename(old, target):
            raise OSError(f"{path} is in {staged}.old now, the new rows are in {staged}")
        raise OSError(f"{path} can't be replaced; the new rows are in {staged}")
    if had:
        fs.delete(old, True)


def run_versioned(df: DataFrame, folder: str, run: str) -> None:
    """Writes run=<run> and then makes it the latest run. Until that is done, and if it never is, the one before is the latest."""
    df.write.mode("overwrite").parquet(f"{folder}/run={run}")
    write_version(df.sparkSession.createDataFrame([(run,)], "run string").coalesce(1), f"{folder}/latest")


def read_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the latest run."""
    return spark.read.parquet(f"{folder}/run={read_version(spark, f'{folder}/latest').first()['run']}")


def as_json(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as JSON text, nulls written out."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def write_version(df: DataFrame, path: str, unique: list[list[str]] | None = None, keep: int = 2) -> int:
    """Writes df as the next version of the table at path (a folder of v=<n>) and holds each of the key sets against
    uniqueness before it counts. A reader finds the version before until this one is whole; a run that breaks off leaves a
    version without its mark, which nobody reads. Versions older than the last keep are deleted."""
    spark = df.sparkSession
    held = versions(spark, path)
    n = max(held, default=0) + 1
    staged, _ = _path(spark, f"{path}/.v={n}.{uuid.uuid4().hex}")
    df.write.parquet(str(staged.toString()))
    for keys in unique or []:
        assert_unique(spark.read.schema(df.schema).parquet(str(staged.toString())), keys)
    target, fs = _path(spark, f"{path}/v={n}")
    if fs.exists(target) or not fs.rename(staged, target):
        raise OSError(f"{path} has a version {n} by another writer; the new rows are in {staged.toString()}")
    for old in sorted(held)[: max(0, len(held) + 1 - keep)]:
        fs.delete(_path(spark, f"{path}/v={old}")[0], True)
    return n


def versions(spark: SparkSession, path: str) -> list[int]:
    """The whole versions of a table."""
    folder, fs = _path(spark, path)
    if not fs.exists(folder):
        return []
    found = [re.fullmatch(r"v=(\d+)", s.getPath().getName()) for s in fs.listStatus(folder)]
    return sorted(int(m.group(1)) for m in found if m and fs.exists(_path(spark, f"{path}/{m.group(0)}/_SUCCESS")[0]))


def read_version(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """The last whole version (or version n)."""
    held = versions(spark, path)
    if not held or n is not None and n not in held:
        raise FileNotFoundError(f"{path} has no such version")
    return spark.read.parquet(f"{path}/v={n or held[-1]}")


def append_days(df: DataFrame, path: str, day: str, max_records: int = 5_000_000) -> None:
    """Adds df's rows to the partitions of their days."""
    df.hint("rebalance", day).write.mode("append").option("maxRecordsPerFile", max_records).partitionBy(day).parquet(path)


def write_days(df: DataFrame, path: str, day: str, max_records: int = 5_000_000) -> None:
    """Writes df into the partitions of its days: the partitions that it has rows for are replaced whole, all others stay. A
    second run with the same rows changes nothing. Rows are gathered by day, so that small days have one file; a day of many rows is
    split among tasks by the planner, and files have at most max_records rows."""
    df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records).partitionBy(day).parquet(path)


def read_days(spark: SparkSession, path: str, schema: str, day: str, run_date: date | None = None) -> DataFrame:
    """The rows of all days, or of one, of which only the partition is read."""
    rows = spark.read.schema(schema).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], schema)
    return rows.where(F.col(day) == run_date.isoformat()) if run_date else rows


def export(df: DataFrame, path: str, kind: str, max_records: int = 1_000_000, mode: str = "overwrite") -> None:
    """df as csv (with a header), json (a line for each row) or parquet files of at most max_records rows."""
    if kind not in ("csv", "json", "parquet"):
        raise ValueError(f"{kind} isn't a kind of export")
    out = df.write.mode(mode).option("maxRecordsPerFile", max_records)
    (out.option("header", True) if kind == "csv" else out.option("ignoreNullFields", False) if kind == "json" else out).format(kind).save(path)


def resume_ndjson(df: DataFrame, path: str, keys: list[str], order: list[Column] | None = None, max_records: int = 1_000_000) -> None:
    """Appends the rows whose key the JSON lines at path lack, so that a run that broke off goes on where it was."""
    spark = df.sparkSession
    old = spark.read.schema(df.schema).json(path) if table_exists(spark, path) else df.where("false")
    export(insert_only_new(df, old, keys, order), path, "json", max_records, "append")
