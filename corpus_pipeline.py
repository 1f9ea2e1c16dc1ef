"""Corpus pipeline: quality rules, line dedup, near-dedup, benchmark decontamination, token encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet in the shared folder
and hands what it reads back to the next. All but the last stage return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarack.llm import bpe, decontaminate, lines, quality, simhash
from tamarack.llm.common import drop_scratch, given_out, materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned cutoffs. A null text doesn't pass."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without the lines that a group's first occurrence repeats; n_chars follows the text."""
    out = lines.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or more) the document with the smallest doc_id."""
    return simhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window stands."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to."""
    return bpe.round_trip(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", token_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), len(given_out)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_scratch(spark, since, given_out[-1:])  # the stage's rows are written: what led to them isn't needed any more
    return docs


#: Groups of near copies, line groups and the encoding aren't expressible in SQL; tests/llm/test_pipeline.py holds each stage
#: against a brute-force version.
ORACLE_SQL = None
