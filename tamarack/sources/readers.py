"""Readers with explicit schemas. A folder without matching files gives an empty DataFrame, not an error."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import id_from_file

SEARCH = "id struct<kind:string,videoId:string>, snippet struct<title:string,description:string,publishedAt:string,channelTitle:string>"
TRANSCRIPT = "text string, start double, duration double"
COMMENTS = "id string, snippet struct<videoId:string,topLevelComment:struct<snippet:struct<videoId:string,authorDisplayName:string,textDisplay:string,likeCount:bigint,publishedAt:string>>>"
NEWS = "gid string, title string, contents string, date bigint, appid int"
REVIEWS = "recommendationid string, review string, timestamp_created bigint, timestamp_updated bigint"
GAMES = "appid int, details string"
PARTS = "appid int, name string"
PLAYERS = "appid int, name string, current_players int, timestamp string"


def there(spark: SparkSession, path: str) -> bool:
    """Whether a path (or a glob) has anything: only that gives an empty table, other errors are raised."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def ndjson(spark: SparkSession, folder: str, schema: str, prefix: str = "", suffix: str = "*.ndjson") -> DataFrame:
    """All prefix*.ndjson files of a folder."""
    if not there(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", f"{prefix}{suffix}").json(folder)


def dated_ndjson(spark: SparkSession, folder: str, schema: str, prefix: str, run_date: date) -> DataFrame:
    """The file of one day, prefix_YYYY_MM_DD.ndjson and no other."""
    return ndjson(spark, folder, schema, f"{prefix}_{run_date:%Y_%m_%d}", ".ndjson")


def tagged_ndjson(spark: SparkSession, folder: str, schema: str, prefix: str, name: str) -> DataFrame:
    """All files with the part of their name behind prefix as a column; unreadable files are skipped."""
    if not there(spark, folder):
        return spark.createDataFrame([], f"{schema}, {name} string")
    rows = spark.read.schema(schema).option("pathGlobFilter", f"{prefix}*.ndjson").option("ignoreCorruptFiles", True).json(folder)
    return rows.withColumn(name, id_from_file(F.col("_metadata.file_name"), prefix))


def reviews_by_game(spark: SparkSession, folder: str, prefix: str = "reviews_") -> DataFrame:
    """The reviews of files reviews_<appid>.ndjson, which don't name their game themselves, with its appid."""
    rows = tagged_ndjson(spark, folder, REVIEWS, prefix, "appid")
    return rows.withColumn("appid", F.col("appid").try_cast("int"))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array each; missing or malformed gives no rows."""
    if not there(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def numbered_parts(spark: SparkSession, folder: str, schema: str, prefix: str) -> DataFrame:
    """prefix<n>.json files as (part, position, fields); files without a number are left out."""
    if not there(spark, folder):
        return spark.createDataFrame([], f"part int, position int, {schema}")
    raw = spark.read.option("pathGlobFilter", f"{prefix}*.json").text(folder, wholetext=True)
    part = F.regexp_extract(F.col("_metadata.file_name"), rf"^{prefix}(\d+)\.json$", 1).try_cast("int")
    rows = raw.select(part.alias("part"), F.from_json("value", f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>").alias("items")).where("part IS NOT NULL")
    return rows.select("part", F.posexplode("items").alias("position", "item")).select("part", "position", "item.*")


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def exists(df: DataFrame) -> bool:
    return not df.isEmpty()
