"""Landing to trusted: raw records to typed, cleaned rows. Every function takes the run date; nothing asks the clock."""

from __future__ import annotations

from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import validate as V
from ..operators.keyed import keep_first, keep_one

DETAILS = (
    "type string, name string, required_age string, is_free boolean, controller_support string, detailed_description string, about_the_game string,"
    "short_description string, supported_languages string, legal_notice string, pc_requirements string, mac_requirements string, linux_requirements string,"
    "developers array<string>, publishers array<string>, price_overview struct<currency:string,initial:string,final:string,discount_percent:string,"
    "initial_formatted:string,final_formatted:string>, platforms struct<windows:boolean,mac:boolean,linux:boolean>, categories array<struct<description:string>>,"
    "genres array<struct<description:string>>, release_date struct<date:string>, recommendations struct<total:int>, metacritic struct<score:int>,"
    "ratings struct<esrb:struct<rating:string>,pegi:struct<rating:string>,usk:struct<rating:string>,cero:struct<rating:string>>,"
    "age_ratings struct<esrb:string,pegi:string,usk:string,cero:string>, dlc array<string>, fullgame struct<appid:string,name:string>"
)
TEXTS = ("name", "detailed_description", "about_the_game", "short_description", "supported_languages", "legal_notice")


def unwrap(raw: DataFrame, key: str, body: str) -> DataFrame:
    """raw answers {"<id>": {"success": ..., "data": {...}}} as (key, details, fetch_error): the data as JSON text where the answer
    says success, null where it says no, and fetch_error where there is no answer to read for the id - those are asked for again,
    the others aren't."""
    answer = F.from_json(body, "map<string,struct<success:boolean,data:string>>")[F.col(key).cast("string")]
    return raw.select(key, F.when(answer["success"], answer["data"]).alias("details"), answer["success"].isNull().alias("fetch_error"))


def to_fetch(wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """The keys that weren't answered yet: those that never landed or landed with an error only."""
    return wanted.select(key).distinct().join(landed.where("NOT fetch_error").select(key), key, "left_anti")


def until_mark(pages: DataFrame, marks: DataFrame, key: str, page: str, items: str, time: str) -> DataFrame:
    """The items (structs in the array column items) of pages in their order that are later than the key's mark, with key and
    page. Reading ends behind the first page that has an item at or before the mark, as a source in order of time would be read;
    no mark reads all pages. The running minimum of the pages' earliest times says so without a loop."""
    w = Window.partitionBy(key).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    least = F.array_min(F.transform(items, lambda x: x[time]))
    rows = pages.withColumn("__before", F.min(least).over(w)).join(marks.select(key, F.col("mark").alias("__mark")), key, "left")
    rows = rows.where("__mark IS NULL OR __before IS NULL OR __before > __mark").select(key, page, "__mark", F.explode(items).alias("__item"))
    return rows.where(F.col("__mark").isNull() | (F.col(f"__item.{time}") > F.col("__mark"))).select(key, page, "__item.*")


def games(raw: DataFrame, run_date: date, clean=T.clean_text, dates: bool = True) -> DataFrame:
    """raw (appid, details as JSON text) to trusted rows; details that are null give a row of blanks, which keeps the id from
    being asked for again. dates=False leaves release dates as they came."""
    d = F.from_json("details", DETAILS)
    rows = raw.select("appid", "details", d.alias("d"))
    c = lambda x: F.col(f"d.{x}")
    cleaned = {x: clean(c(x)).alias(x) for x in TEXTS}
    needs = {f"{x}_requirements": V.requirements(c(f"{x}_requirements"), clean).alias(f"{x}_requirements") for x in ("pc", "mac", "linux")}
    when = F.coalesce(c("release_date.date"), F.lit(""))
    names = lambda x: F.coalesce(c(x), F.array().cast("array<string>")).alias(x)
    # two names of the field are in use, and under the first an object that holds the code or the code itself
    codes = {s: F.coalesce(F.get_json_object(c(f"age_ratings.{s}"), "$.rating"), c(f"age_ratings.{s}"), c(f"ratings.{s}.rating")) for s in V.AGE_RATINGS}
    return rows.select(
        "appid", clean(c("type")).alias("type"), cleaned["name"], V.required_age(c("required_age")).alias("required_age"), F.coalesce(c("is_free"), F.lit(False)).alias("is_free"),
        clean(c("controller_support")).alias("controller_support"), *[cleaned[x] for x in TEXTS[1:]], *needs.values(),
        names("developers"), names("publishers"), F.when(c("price_overview").isNotNull(), c("price_overview").withField("final", V.price(c("price_overview.final")))).alias("price_overview"),
        c("platforms").alias("platforms"), V.descriptions(c("categories")).alias("categories"), V.descriptions(c("genres")).alias("genres"),
        (V.release_date(when) if dates else when).alias("release_date"), V.total_or_zero(F.get_json_object("details", "$.recommendations"), "total").alias("recommendations_total"), c("metacritic.score").alias("metacritic_score"),
        V.age_rating(**codes).alias("age_rating"), V.int_array(c("dlc")).alias("dlc"), V.parent_item(c("fullgame"), clean).alias("fullgame"),
        F.lit(run_date.isoformat()).alias("updated_at"),
    )


def news(raw: DataFrame, run_date: date, clean=T.clean_text) -> DataFrame:
    """One row per gid; of several the latest, then the larger text."""
    rows = raw.select(
        F.col("gid").cast("string").alias("gid"), F.col("title").cast("string").alias("title"), clean(F.col("contents").cast("string")).alias("contents"),
        V.epoch_date(F.col("date").cast("string").try_cast("bigint")).alias("date"), F.col("appid").cast("string").try_cast("int").alias("appid"), F.lit(run_date.isoformat()).alias("updated_at"),
    )
    return keep_one(rows, ["gid"], [F.desc("date"), F.desc("contents"), F.desc("title")])


def reviews(raw: DataFrame, clean=T.clean_text) -> DataFrame:
    rows = raw.withColumn("review_clean", clean(F.col("review")))
    for c in ("timestamp_created", "timestamp_updated"):
        rows = rows.withColumn(c.replace("timestamp", "date"), F.to_date(F.timestamp_seconds(c)))
    return keep_one(rows.where("review_clean <> ''"), ["recommendationid"], [F.desc("timestamp_updated"), F.desc("review")])


def videos(raw: DataFrame, key: str, most: int = 20) -> DataFrame:
    """The newest videos of a search by key: what has a video's id (channels and lists have none), each video once for a key."""
    rows = raw.where(F.col("id.videoId").isNotNull() & (F.col("id.videoId") != "")).select(
        key, F.col("id.videoId").alias("videoId"), F.col("snippet.title").alias("title"), F.col("snippet.channelTitle").alias("channel"), F.col("snippet.publishedAt").alias("publishedAt")
    )
    newest = [F.desc("publishedAt"), F.desc("videoId"), F.desc("title")]
    return keep_first(keep_one(rows, [key, "videoId"], newest), [key], newest, most)


def polls(raw: DataFrame, key: str, time: str, count: str) -> DataFrame:
    """A fact for each poll: key, polled_at, day and players (-1 where the poll failed), the last of a key and time."""
    rows = raw.select(key, F.col(time).alias("polled_at"), F.date_format(time, "yyyy-MM-dd").alias("day"), V.polled_players(F.col(count)).alias("players"))
    return keep_one(rows, [key, "polled_at"], [F.desc("players")])


def comments(raw: DataFrame, clean=T.clean_text) -> DataFrame:
    """videoId, author, text, text_clean, publishedAt (day), likeCount of each comment id once."""
    s = lambda x: F.col(f"snippet.topLevelComment.snippet.{x}")
    rows = keep_one(raw, ["id"], [F.desc(s("publishedAt")), F.desc(s("textDisplay"))])
    return rows.select(
        s("videoId").alias("videoId"), s("authorDisplayName").alias("author"), s("textDisplay").alias("text"), clean(s("textDisplay")).alias("text_clean"),
        F.substring(F.coalesce(s("publishedAt"), F.lit("")), 1, 10).alias("publishedAt"), F.coalesce(s("likeCount"), F.lit(0)).alias("likeCount"),
    )


def assemble(segments: DataFrame, key: str, order: str, text: str, name: str) -> DataFrame:
    """The segments' texts of each key in order, a blank between; nulls are skipped."""
    return segments.groupBy(key).agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])).alias(name))


def transcripts(segments: DataFrame) -> DataFrame:
    return assemble(segments, "video_id", "start", "text", "transcription").withColumnRenamed("video_id", "videoId")


def all_games(parts: DataFrame) -> DataFrame:
    """The first of each appid over numbered parts, names trimmed and not empty."""
    named = parts.withColumn("name", F.trim("name")).where("length(name) > 0 AND appid IS NOT NULL")
    return keep_one(named, ["appid"], [F.asc("part"), F.asc("position")]).select("appid", "name")


def monthly_players(cells: DataFrame, percent=V.chart_percent) -> DataFrame:
    """appid, month, avg_players, gain_loss, gain_loss_percent, peak_players from table rows (appid, position, cells): rows of
    at least five cells with a month; the last row of a month counts."""
    rows = cells.where(F.size("cells") >= 5).withColumn("month", V.month(F.trim(F.get("cells", F.lit(0))))).where("month IS NOT NULL")
    n = lambda i: F.trim(F.get("cells", F.lit(i)))
    rows = rows.select("appid", "month", "position", V.chart_number(n(1)).alias("avg_players"), V.chart_number(n(2)).alias("gain_loss"), percent(n(3)).alias("gain_loss_percent"), V.chart_number(n(4)).alias("peak_players"))
    return keep_one(rows, ["appid", "month"], [F.desc("position")]).drop("position")


def polls_by_month(polls: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """Average and peak of the polled values of each key and month, and how many polls there were."""
    return polls.groupBy(key, F.date_format(time, "yyyy-MM").alias("month")).agg(F.round(F.avg(value), 2).alias("avg_players"), F.round(F.max(value), 2).alias("peak_players"), F.count(F.lit(1)).alias("polls"))


def table_cells(html: Column, css_class: str) -> Column:
    """Cells of each row but the first of the table of this class, as array<array<string>>."""
    @F.arrow_udf("array<array<string>>")
    def run(pages: pa.Array) -> pa.Array:
        from .html_table import rows_of

        return pa.array([rows_of(p.as_py() or "", css_class)[1:] for p in pages], pa.list_(pa.list_(pa.string())))

    return run(html)
