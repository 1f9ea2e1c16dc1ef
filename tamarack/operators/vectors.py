"""Feature vectors, exact inner-product search and k-means."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Defaults of the published parameters.
MIN_K, MAX_K, SEED, THRESHOLD = 5, 30, 42, 0.90
#: Query vectors that a pass over the items holds, and rows and queries of one block of inner products.
PASS_QUERIES, BLOCK_ROWS, BLOCK_QUERIES = 100_000, 1024, 1024
#: Similarities are rounded to so many decimals before they are ranked, so that the order of a sum decides nothing.
DIGITS = 6


#: The largest vocabulary that becomes a vector of its own.
MOST_LABELS = 1 << 18


def vocabulary(df: DataFrame, labels: str) -> DataFrame:
    """label, position (from 0) of each distinct label in order. Labels are made distinct before they meet; more than MOST_LABELS
    raise ValueError, as every row would get a vector of that length."""
    distinct = df.select(F.explode(labels).alias("label")).where("label IS NOT NULL").distinct()
    if (n := distinct.limit(MOST_LABELS + 1).count()) > MOST_LABELS:
        raise ValueError(f"{labels} has more than {MOST_LABELS} labels, {n} at least")
    return distinct.agg(F.array_sort(F.collect_list("label")).alias("v")).select(F.posexplode("v").alias("position", "label")).select("label", "position")


def multi_hot(labels: Column, vocab: list[str]) -> Column:
    """0/1 for each label of the vocabulary, which is one constant of the plan; labels outside it are ignored."""
    if not vocab:
        return F.array().cast("array<int>")
    names = F.from_json(F.lit(json.dumps(vocab)), "array<string>")
    return F.transform(names, lambda v: F.coalesce(F.array_contains(labels, v), F.lit(False)).cast("int"))


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v: Column) -> Column:
    """v with length 1; a zero vector stays."""
    n = F.sqrt(inner_product(v, v))
    return F.when(n == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x.cast("double") / n))


def features(*parts: Column) -> Column:
    """The parts (arrays or numbers as arrays) one after the other, as doubles."""
    return F.concat(*[p.cast("array<double>") for p in parts])


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of equally long vectors without nulls."""
    sizes = pc.list_value_length(vectors)
    if len(vectors) and pc.min(sizes).as_py() != width or len(vectors) and pc.max(sizes).as_py() != width:
        raise ValueError(f"vectors must have {width} components, as the queries have")
    return pc.fill_null(vectors.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, width)


class _Best:
    """The best items of each query of a block: similarity, then the smaller key."""

    def __init__(self, queries: np.ndarray, top: int | None, threshold: float | None):
        self.queries, self.top, self.least = queries, top, -np.inf if threshold is None else threshold
        self.floor = np.full(len(queries), self.least)
        self.row = np.empty(0, np.int64)
        self.sim, self.key = np.empty(0), None

    def add(self, x: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Takes in a block of items; without top gives back its pairs at once."""
        sims = np.round(self.queries @ x.T, DIGITS) + 0.0
        row, at = np.nonzero(sims >= self.floor[:, None])
        found = sims[row, at]
        if self.top is None:
            return row, keys[at], found
        self.row, self.sim = np.concatenate([self.row, row]), np.concatenate([self.sim, found])
        self.key = keys[at] if self.key is None else np.concatenate([self.key, keys[at]])
        order = np.lexsort((self.key, -self.sim, self.row))
        row = self.row[order]
        begin = np.searchsorted(row, row)
        order = order[np.arange(len(order)) - begin < self.top]
        self.row, self.sim, self.key = self.row[order], self.sim[order], self.key[order]
        # a query with as many as it may have takes only what is as good as its last
        full = np.flatnonzero(np.bincount(self.row, minlength=len(self.queries)) >= self.top)
        self.floor[full] = self.sim[np.searchsorted(self.row, full, "right") - 1]
        return None


def search(items: DataFrame, queries: DataFrame, vector: str, key: str, query_key: str | None = None, top: int | None = None, threshold: float | None = None) -> DataFrame:
    """query, key, similarity (and rank, if top is given) of the items by inner product with each query row: those of at least
    the threshold, or the top ones of each, equal ones by key.

    Queries are read in passes of about PASS_QUERIES, dealt by a hash of their row; the vectors of one pass are sent to
    the workers. There blocks of items are multiplied with blocks of queries, and each partition keeps only the top of each query,
    which one window over the partitions' rows merges; no pair of rows is joined. Memory is bounded by the blocks and the pass.

    Rows with a null key or vector are left out; a vector with a null or NaN component is similar to nothing; vectors of another
    length than the queries raise ValueError; equal query rows count once, those of one key with several vectors are ranked together."""
    spark, query_key = items.sparkSession, query_key or key
    if top is None and threshold is None:
        raise ValueError("a top or a threshold is needed")
    asked = queries.select(F.col(query_key).alias("q"), F.col(vector).cast("array<double>").alias("v")).where("q IS NOT NULL AND v IS NOT NULL").distinct()
    passes = -(-asked.count() // PASS_QUERIES)
    kind, query_kind = items.schema[key].dataType.simpleString(), queries.schema[query_key].dataType.simpleString()
    number = kind in ("tinyint", "smallint", "int", "bigint")
    schema = f"place int, q int, key {'bigint' if number else 'string'}, similarity double"
    rows = items.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("bigint" if number else "string"), F.col(vector).cast("array<float>" if "float" in items.schema[vector].dataType.simpleString() else "array<double>"))
    out = spark.createDataFrame([], f"query {query_kind}, key {kind}, similarity double")
    for n in range(passes):
        part = asked.where(F.pmod(F.xxhash64("q", "v"), F.lit(passes)) == n).toArrow() if passes > 1 else asked.toArrow()
        if not part.num_rows:
            continue
        width = len(part.column("v")[0])
        sent = spark.sparkContext.broadcast(_matrix(part.column("v").combine_chunks(), width))

        def run(batches: Iterator[pa.RecordBatch], sent=sent, width=width) -> Iterator[pa.RecordBatch]:
            blocks = [_Best(sent.value[a : a + BLOCK_QUERIES], top, threshold) for a in range(0, len(sent.value), BLOCK_QUERIES)]

            def batch(k, row, keys, sims):
                return pa.RecordBatch.from_arrays([pa.array(np.full(len(row), k, np.int32)), pa.array(row.astype(np.int32)), pa.array(keys.tolist(), pa.int64() if number else pa.string()), pa.array(sims)], ["place", "q", "key", "similarity"])

            for b in batches:
                for at in range(0, b.num_rows, BLOCK_ROWS):
                    some = b.slice(at, BLOCK_ROWS)
                    x, keys = _matrix(some.column(1), width), some.column(0).to_numpy(zero_copy_only=False)
                    keys = keys if number else keys.astype(str)
                    for k, block in enumerate(blocks):
                        if (pairs := block.add(x, keys)) is not None and len(pairs[0]):
                            yield batch(k, *pairs)
            for k, block in enumerate(blocks):
                if top is not None and len(block.row):
                    yield batch(k, block.row, block.key, block.sim)

        # the keys of a pass go the way that its vectors went
        names = spark.createDataFrame(pa.table({"__at": pa.array(range(part.num_rows), pa.int32()), "query": part.column("q")}))
        found = rows.mapInArrow(run, schema).withColumn("__at", F.col("place") * BLOCK_QUERIES + F.col("q"))
        found = found.join(F.broadcast(names), "__at").select(F.col("query").cast(query_kind), F.col("key").cast(kind), "similarity")
        out = out.unionByName(found)
    if top is None:
        return out
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), F.asc("key")))
    return out.withColumn("rank", rank).where(F.col("rank") <= top)


def similar(items: DataFrame, query: DataFrame, vector: str, key: str, threshold: float = THRESHOLD) -> DataFrame:
    """The items' rows (of which key is the identity) with query and similarity: for each row of query those whose inner product
    is at least the threshold, best first."""
    found = search(items, query, vector, key, threshold=threshold).withColumnRenamed("key", "__key")
    return items.join(found, F.col(key) == F.col("__key")).drop("__key").orderBy(F.desc("similarity"), key)


def similarity_report(found: DataFrame, inputs: DataFrame, items: DataFrame) -> DataFrame:
    """The published report of a search: inputs (query, name, description, genres, categories) beside items (key, name,
    cluster); an input that is no item of the catalogue has no appid."""
    known = F.when(F.col("listed"), F.col("query"))
    report = found.join(inputs, "query").join(items.select("key", F.col("name").alias("similar_name"), "cluster"), "key")
    return report.select(
        known.alias("input_appid"), F.col("name").alias("input_name"), F.col("description").alias("input_description"), F.array_join("genres", "; ").alias("input_genres"),
        F.array_join("categories", "; ").alias("input_categories"), F.col("key").alias("similar_appid"), "similar_name", "cluster", F.round("similarity", 4).alias("similarity"),
    )


def fit_clusters(df: DataFrame, vector: str, k: int, seed: int = SEED) -> tuple[KMeansModel, DataFrame]:
    rows = df.withColumn("__features", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="__features", predictionCol="cluster").fit(rows)
    return model, model.transform(rows).drop("__features")


def silhouette_sweep(df: DataFrame, vector: str, ks: range = range(MIN_K, MAX_K + 1), seed: int = SEED) -> list[tuple[int, float]]:
    """(k, silhouette) for each k; one fit each over the cached vectors."""
    rows = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")).persist()
    try:
        scores = []
        for k in ks:
            out = KMeans(k=k, seed=seed).fit(rows).transform(rows)
            scores.append((k, ClusteringEvaluator().evaluate(out)))
        return scores
    finally:
        rows.unpersist()


def best_k(scores: list[tuple[int, float]]) -> int:
    """The k of the best score, the lowest of equals."""
    return min(scores, key=lambda s: (-s[1], s[0]))[0]
