"""Feature vectors of catalogue items as one MLlib pipeline: hashed and weighted words, labels by a fitted vocabulary, age.

The pipeline is fitted once and saved; a new item goes through the saved one, so that it meets the training vocabulary and
weights (labels outside the vocabulary are ignored). Every stage is MLlib's own, so a saved pipeline is read by any session.

Null texts count as empty, null labels as none, a null age as 0; an item without words, labels and age has the zero vector."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, Normalizer, RegexTokenizer, SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import read_version, write_version
from .vectors import MAX_K, MIN_K, SEED, best_k, vocabulary

#: Buckets of words.
BUCKETS = 1 << 12
#: What parts words: all but letters and digits.
GAPS = "[^\\p{L}\\p{N}]+"


def combined(texts: list[str], labels: list[str], age: str) -> SQLTransformer:
    """full_description: the texts with blanks between, trimmed; labels without nulls; age between 0 and 1."""
    text = " || ' ' || ".join(f"coalesce({c}, '')" for c in texts)
    lists = "".join(f", coalesce({c}, cast(array() AS array<string>)) AS {c}__labels" for c in labels)
    years = f"least(greatest(coalesce(try_cast({age} AS double), 0D), 0D), 100D) / 100"
    return SQLTransformer(statement=f"SELECT *, trim({text}) AS full_description{lists}, {years} AS age__scaled FROM __THIS__")


def label_vocabulary(df: DataFrame, column: str) -> list[str]:
    """The distinct labels in order, as many as a vocabulary may have."""
    return [r["label"] for r in vocabulary(df, column).orderBy("position").collect()]


def feature_pipeline(df: DataFrame, texts: list[str], labels: list[str], age: str, buckets: int = BUCKETS) -> PipelineModel:
    """The pipeline fitted on df. It adds full_description, words (counts by bucket), features_raw (words weighted by inverse
    document frequency, the labels' 0/1, age) and features_unit (the same with length 1)."""
    stages: list = [combined(texts, labels, age)]
    stages.append(RegexTokenizer(inputCol="full_description", outputCol="words__list", pattern=GAPS, minTokenLength=1))
    stages.append(HashingTF(inputCol="words__list", outputCol="words", numFeatures=buckets))
    stages.append(IDF(inputCol="words", outputCol="words__weighted"))
    for c in labels:
        names = label_vocabulary(df, c) or [""]  # a vector has one place at least; no label is empty
        stages.append(CountVectorizerModel.from_vocabulary(names, f"{c}__labels", f"{c}__hot").setBinary(True))
    stages.append(VectorAssembler(inputCols=["words__weighted", *[f"{c}__hot" for c in labels], "age__scaled"], outputCol="features_raw"))
    stages.append(Normalizer(inputCol="features_raw", outputCol="features_unit", p=2.0))
    return Pipeline(stages=stages).fit(df)


def item_columns(published: DataFrame) -> DataFrame:
    """What features need of the published games, and no other column is read: the key, the name, the texts, labels and age."""
    return published.where("type = 'game'").select("appid", "name", "detailed_description", "about_the_game", "short_description", "genres", "categories", "required_age")


def drop_steps(df: DataFrame) -> DataFrame:
    """df without the columns between the stages."""
    return df.select(*[c for c in df.columns if not c.endswith(("__labels", "__hot", "__list", "__weighted", "__scaled"))])


def fit_best(df: DataFrame, pipeline: PipelineModel, ks: range = range(MIN_K, MAX_K + 1), seed: int = SEED, column: str = "features_raw") -> tuple[PipelineModel, list[tuple[int, float]]]:
    """The pipeline with the k-means model of the best silhouette behind it (the lowest k of equals), and (k, silhouette) of
    all. The vectors are computed once and cached; every model but the best is let go."""
    rows = pipeline.transform(df).select(column).persist()
    try:
        scores, best = [], None
        for k in ks:
            model: KMeansModel = KMeans(k=k, seed=seed, featuresCol=column, predictionCol="cluster").fit(rows)
            scores.append((k, ClusteringEvaluator(featuresCol=column, predictionCol="cluster").evaluate(model.transform(rows))))
            if best is None or best_k(scores) == k:
                best = model
    finally:
        rows.unpersist()
    return PipelineModel(stages=[*pipeline.stages, best]), scores


def save_run(model: PipelineModel, scores: list[tuple[int, float]], items: DataFrame, folder: str, run: str, key: str, name: str) -> None:
    """Writes folder/run=<run>/{model,scores,items} and then points folder/latest to the run. What a reader finds by latest is
    whole at any time; a run that breaks off leaves the one before."""
    spark, at = items.sparkSession, f"{folder}/run={run}"
    model.write().overwrite().save(f"{at}/model")
    best = best_k(scores)
    spark.createDataFrame([(k, float(s), k == best) for k, s in scores], "k int, silhouette_score double, best boolean").coalesce(1).write.mode("overwrite").parquet(f"{at}/scores")
    out = model.transform(items).select(F.col(key).alias("key"), F.col(name).alias("name"), "cluster", "features_raw", "features_unit")
    out.write.mode("overwrite").parquet(f"{at}/items")
    write_version(spark.createDataFrame([(run,)], "run string").coalesce(1), f"{folder}/latest")


def latest_run(spark: SparkSession, folder: str) -> str:
    return read_version(spark, f"{folder}/latest").first()["run"]


def load_run(spark: SparkSession, folder: str, run: str | None = None) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """The model, scores and items of a run (the latest, if none is named)."""
    at = f"{folder}/run={run or latest_run(spark, folder)}"
    return PipelineModel.load(f"{at}/model"), spark.read.parquet(f"{at}/scores"), spark.read.parquet(f"{at}/items")


def vocabularies(model: PipelineModel) -> dict[str, list[str]]:
    """The labels of each label column, as the fitted pipeline holds them."""
    return {m.getInputCol().removesuffix("__labels"): list(m.vocabulary) for m in model.stages if isinstance(m, CountVectorizerModel)}
