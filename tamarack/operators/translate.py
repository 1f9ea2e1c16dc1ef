"""Translation as one stage: each distinct text is given to the translator once, and what it answered is kept in a table.

The translator is a function from (digest, lang, text) to (digest, translated), so that it may be a service called in
mapInArrow with its own pauses and retries, or a join with a dictionary. A text for which it answers null, or nothing, stays as it
is and is asked for again in the next run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import translate_action
from ..sources.sinks import table_exists

CACHE = "digest string, translated string"


def known_translations(df: DataFrame, cache: str) -> DataFrame:
    """digest, translated: one row for each digest of the table."""
    spark = df.sparkSession
    rows = spark.read.schema(CACHE).parquet(cache) if table_exists(spark, cache) else spark.createDataFrame([], CACHE)
    return rows.groupBy("digest").agg(F.min("translated").alias("translated"))


def translate_stage(df: DataFrame, text: str, lang: str, cache: str, translate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """df with text in English and action (see translate_action). Short texts are always translated, longer ones unless lang
    says English; a null or empty text is ''. Only texts that the table at cache lacks go to the translator; they are written
    there before they are used, so nothing is asked twice, however often the result is read."""
    rows = df.withColumn("action", translate_action(F.col(text), F.col(lang))).withColumn("__digest", F.md5(F.col(text)))
    wanted = rows.where(F.col("action").isin("short", "translate")).select(F.col("__digest").alias("digest"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    # the digests alone say which are new; then each of their texts moves once
    new = wanted.join(known_translations(df, cache).select("digest"), "digest", "left_anti").dropDuplicates(["digest"])
    translate(new).select("digest", "translated").where("translated IS NOT NULL").write.mode("append").parquet(cache)
    known = known_translations(df, cache).select(F.col("digest").alias("__known"), F.col("translated").alias("__translated"))
    out = F.when(F.col("action") == "empty", "").when(F.col("action") == "keep_en", F.col(text)).otherwise(F.coalesce("__translated", F.col(text)))
    return rows.join(known, F.col("__digest") == F.col("__known"), "left").withColumn(text, out).drop("__digest", "__known", "__translated")
