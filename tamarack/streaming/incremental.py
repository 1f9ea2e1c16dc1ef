"""Incremental loads with Structured Streaming: new files only, each batch inserted by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import append_new


def available_files(spark: SparkSession, folder: str, schema: str, pattern: str = "*.ndjson") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).json(folder)


def load_new(stream: DataFrame, clean: Callable[[DataFrame], DataFrame], path: str, keys: list[str], checkpoint: str) -> None:
    """Runs over all files that the checkpoint hasn't seen and ends. A batch that is run again inserts nothing twice."""
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(lambda rows, _: append_new(clean(rows), path, keys) and None).start()
    query.awaitTermination()


def hourly_players(stream: DataFrame, time: str = "ts", late: str = "2 hours") -> DataFrame:
    """Average and peak of current_players for each appid and hour; polls later than late are left out."""
    rows = stream.withWatermark(time, late).groupBy(F.window(time, "1 hour"), "appid")
    return rows.agg(F.avg("current_players").alias("avg_players"), F.max("current_players").alias("peak_players"))


def dedup_exact(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key that ever comes. The state store holds every key; a restart goes on with it."""
    return stream.dropDuplicates(keys)


def dedup_recent(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first row of each key among those that come within late of each other; the state holds these keys alone. Rows later
    than late behind the newest are dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def above_marks(stream: DataFrame, key: str, time: str) -> DataFrame:
    """Rows later than their key's high-water mark, which is the latest time of the batches before (none: all rows). Rows of one
    batch are held against the same mark, in whatever order they come; rows at the mark or before it, and rows without a time, are
    dropped. The state holds one time for each key; a key's rows pass in Arrow batches, however many there are. Rows without a
    key share one mark."""
    import pandas as pd

    def run(k, batches, state):
        mark = newest = pd.Timestamp(state.get[0], unit="us") if state.exists else pd.Timestamp.min
        for rows in batches:
            fresh = rows[rows[time] > mark]
            if len(fresh):
                newest = max(newest, fresh[time].max())
                yield fresh
        if newest > mark:
            state.update((newest.value // 1000,))

    # the clock of the rows, not of the session's zone
    plain = stream.withColumn(time, F.col(time).cast("timestamp_ntz"))
    return plain.groupBy(key).applyInPandasWithState(run, plain.schema, "mark bigint", "append", "NoTimeout").withColumn(time, F.col(time).cast(stream.schema[time].dataType))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends the stream's rows of all input that the checkpoint hasn't seen to a table, each batch exactly once, and ends."""
    stream.writeStream.trigger(availableNow=True).format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start().awaitTermination()
