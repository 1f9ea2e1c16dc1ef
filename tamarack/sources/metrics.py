"""Counts of a run without jobs of their own: observed while rows pass to a write, kept in a table of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from .sinks import table_exists

RUNS = "run string, step string, metric string, value double"


class Run:
    """The metrics of one run. observe() before a write, record() after all."""

    def __init__(self, run: str):
        self.run, self.seen, self.values = run, [], []

    def observe(self, df: DataFrame, step: str, **metrics: Column) -> DataFrame:
        """df, whose aggregates are known once an action has run over it."""
        seen = Observation()
        self.seen.append((step, seen))
        return df.observe(seen, *[m.alias(n) for n, m in metrics.items()])

    def put(self, step: str, **values: float) -> None:
        self.values += [(self.run, step, n, float(v)) for n, v in values.items()]

    def rows(self) -> list[tuple[str, str, str, float]]:
        """All metrics so far; waits for the actions over what is observed."""
        return [*self.values, *[(self.run, step, n, float(v)) for step, seen in self.seen for n, v in seen.get.items() if v is not None]]

    def record(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.rows(), RUNS).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], RUNS)
