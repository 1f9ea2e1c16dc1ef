"""Queries over the zones: landing to trusted to published, and the writes between them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import keyed as K
from ..operators import publish as P
from ..operators import translate as Z
from ..operators import vectors as X
from ..sources import manifest as W
from ..sources import readers as R
from ..sources import sinks as S
from ..sources.metrics import Run, read_runs
from ..sources.shared import fresh, settled
from ..streaming import incremental as I
from . import landing as L
from .registry import query, t

DAY = date(2024, 5, 1)

# --- landing to trusted -----------------------------------------------------------------------------------------------


def raw_games(spark, d):
    """Answers of a catalogue source, one for each part: no success for some, unreadable for others."""
    p = t(spark, d, "part")
    data = F.struct(
        F.lit("game").alias("type"), F.format_string("<b>%s</b> &amp; %s ", "p_name", "p_brand").alias("name"), (F.col("p_size") - 5).alias("required_age"), (F.col("p_size") > 40).alias("is_free"),
        F.array(F.struct(F.col("p_type").alias("description")), F.struct(F.lit("All").alias("description"))).alias("genres"), F.struct(F.lit("Oct 5, 2021").alias("date")).alias("release_date"),
        F.when(F.col("p_size") > 10, F.struct(F.col("p_size").alias("total"))).alias("recommendations"), F.struct((F.col("p_size") - 20).cast("string").alias("final"), F.lit("EUR").alias("currency")).alias("price_overview"),
        F.array(F.col("p_size").cast("string"), F.lit("x")).alias("dlc"), F.struct(F.struct(F.lit("M").alias("rating")).alias("esrb")).alias("ratings"),
    )
    answer = F.to_json(F.create_map(F.col("p_partkey").cast("string"), F.struct((F.col("p_type") != "ECONOMY").alias("success"), data.alias("data"))))
    return p.select(F.col("p_partkey").cast("int").alias("appid"), F.when(F.col("p_size") == 7, "no answer").otherwise(answer).alias("body"))


@query("SELECT p_partkey::INT AS appid, CASE WHEN p_size <> 7 AND p_type <> 'ECONOMY' THEN '<b>' || p_name || '</b> &amp; ' || p_brand || ' ' END AS name, p_size = 7 AS fetch_error, p_size = 7 AS again FROM part")
def unwrap_answers(spark, d):
    landed = L.unwrap(raw_games(spark, d), "appid", "body")
    again = L.to_fetch(t(spark, d, "part").select(F.col("p_partkey").cast("int").alias("appid")), landed, "appid").withColumn("again", F.lit(True))
    return landed.join(again, "appid", "left").select("appid", F.get_json_object("details", "$.name").alias("name"), "fetch_error", F.coalesce("again", F.lit(False)).alias("again"))


@query("""SELECT p_partkey::INT AS appid, CASE WHEN ok THEN 'game' ELSE '' END AS type, CASE WHEN ok THEN p_name || ' & ' || p_brand ELSE '' END AS name, CASE WHEN ok AND p_size >= 5 THEN (p_size - 5)::VARCHAR ELSE '0' END AS required_age,
  ok AND p_size > 40 AS is_free, CASE WHEN ok THEN p_type || ',All' ELSE '' END AS genres, CASE WHEN ok THEN '2021-10-05' ELSE '' END AS release_date, CASE WHEN ok AND p_size > 10 THEN p_size ELSE 0 END::INT AS recommendations_total,
  CASE WHEN ok AND p_size >= 20 THEN (p_size - 20)::VARCHAR END AS price, CASE WHEN ok THEN p_size::VARCHAR ELSE '' END AS dlc, CASE WHEN ok THEN '17+' END AS age_rating, '2024-05-01' AS updated_at
  FROM (SELECT *, p_size <> 7 AND p_type <> 'ECONOMY' AS ok FROM part)""")
def landing_games(spark, d):
    rows = L.games(L.unwrap(raw_games(spark, d), "appid", "body"), DAY)
    return rows.select(
        "appid", "type", "name", "required_age", "is_free", F.array_join("genres", ",").alias("genres"), "release_date", "recommendations_total", F.col("price_overview.final").alias("price"),
        F.array_join(F.col("dlc").cast("array<string>"), ",").alias("dlc"), "age_rating", "updated_at",
    )


@query("""SELECT l_orderkey::VARCHAR AS recommendationid, max(m) AS review_clean, strftime(max(d), '%Y-%m-%d') AS date_created FROM
  (SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag || ' & ' || l_suppkey END AS m, l_shipdate AS d FROM lineitem) WHERE m <> ''
  GROUP BY l_orderkey, d, m QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY d DESC, m DESC) = 1""")
def landing_reviews(spark, d):
    at = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    text = F.when(F.col("l_returnflag") == "A", "<br>").otherwise(F.format_string("[i]%s[/i]  &amp; %d", "l_returnflag", "l_suppkey"))
    raw = t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("recommendationid"), text.alias("review"), at.alias("timestamp_created"), at.alias("timestamp_updated"))
    return L.reviews(raw).select("recommendationid", "review_clean", F.col("date_created").cast("string").alias("date_created"))


@query("SELECT conv_id::VARCHAR AS \"videoId\", role AS author, role || ' ' || turn AS text_clean, '2024-01-0' || (turn % 9 + 1) AS \"publishedAt\", coalesce(nullif(turn, 2), 0)::BIGINT AS \"likeCount\" FROM (SELECT DISTINCT conv_id, turn, role FROM conversations)")
def landing_comments(spark, d):
    inner = F.struct(
        F.col("conv_id").cast("string").alias("videoId"), F.col("role").alias("authorDisplayName"), F.format_string("<b>%s</b>  %d", "role", "turn").alias("textDisplay"),
        F.when(F.col("turn") != 2, F.col("turn")).cast("bigint").alias("likeCount"), F.format_string("2024-01-0%dT00:00:00Z", F.col("turn") % 9 + 1).alias("publishedAt"),
    )
    c = t(spark, d, "conversations")
    raw = c.select(F.format_string("%d-%d-%s", "conv_id", "turn", "role").alias("id"), F.struct(F.col("conv_id").cast("string").alias("videoId"), F.struct(inner.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    return L.comments(raw).select("videoId", "author", "text_clean", "publishedAt", "likeCount")


@query("""SELECT user_id, event_id::VARCHAR AS "videoId", event_type AS title, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "publishedAt" FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY strftime(ts, '%Y-%m-%dT%H:%M:%S') DESC, event_id::VARCHAR DESC) <= 20""")
def landing_videos(spark, d):
    found = F.when(F.col("event_type") != "error", F.col("event_id").cast("string"))
    answer = F.to_json(F.struct(F.struct(F.lit("youtube#video").alias("kind"), found.alias("videoId")).alias("id"), F.struct(F.col("event_type").alias("title"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("publishedAt")).alias("snippet")))
    raw = t(spark, d, "events").select("user_id", F.from_json(answer, R.SEARCH).alias("x")).select("user_id", "x.*")
    return L.videos(raw, "user_id").select("user_id", "videoId", "title", "publishedAt")


@query("SELECT user_id, ts AS polled_at, strftime(ts, '%Y-%m-%d') AS day, max(CASE WHEN event_type = 'error' THEN -1 ELSE floor(value) END)::BIGINT AS players FROM events GROUP BY 1, 2")
def poll_facts(spark, d):
    """Polls as facts in partitions of their days; a day that is written again has the same rows."""
    e, path = t(spark, d, "events"), fresh(spark, "polls")
    facts = L.polls(e.withColumn("players", F.when(F.col("event_type") != "error", F.floor("value"))), "user_id", "ts", "players")
    S.write_days(facts, path, "day")
    schema = "user_id bigint, polled_at timestamp_ntz, players bigint, day string"
    S.write_days(S.read_days(spark, path, schema, "day", date(2024, 1, 15)), f"{path}-again", "day")
    S.write_days(S.read_days(spark, f"{path}-again", schema, "day"), path, "day")
    return S.read_days(spark, path, schema, "day").select("user_id", "polled_at", "day", "players")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_above_marks(spark, d):
    """Events land as two files, the second of which has the first one's again; each run of the stream takes what is later than
    each user's mark."""
    e, at = t(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")), fresh(spark, "stream")
    schema = "event_id bigint, user_id bigint, event_type string, ts timestamp"
    for rows in (e.where("ts < '2024-01-20'"), e):
        S.export(rows, f"{at}/in", "json", mode="append")
        I.run_available(I.above_marks(I.available_files(spark, f"{at}/in", schema, "*.json"), "user_id", "ts"), f"{at}/out", f"{at}/checkpoint")
    return spark.read.schema(schema).parquet(f"{at}/out").select("event_id", "user_id", "event_type")


@query("""SELECT 'r1' AS run, 'load' AS step, 'events' AS metric, count(*)::DOUBLE AS value FROM events UNION ALL SELECT 'r1', 'load', 'latest', max(event_id)::DOUBLE FROM events UNION ALL SELECT 'r1', 'search', 'num_similares', count(*)::DOUBLE
  FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0 AND round(list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) >= 0.3""")
def run_metrics(spark, d):
    """Counts observed while a load and a search are written."""
    run, at, e = Run("r1"), fresh(spark, "metrics"), t(spark, d, "embeddings")
    run.observe(t(spark, d, "events"), "load", events=F.count(F.lit(1)), latest=F.max("event_id")).write.parquet(f"{at}/events")
    found = X.search(e, e.where("vec_id % 100 = 0"), "embedding", "vec_id", threshold=0.3)
    run.observe(found, "search", num_similares=F.count(F.lit(1))).write.parquet(f"{at}/found")
    run.record(spark, f"{at}/runs")
    return read_runs(spark, f"{at}/runs")


CHARTED = "SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, floor(max(o_totalprice))::BIGINT AS peak FROM orders GROUP BY 1, 2"


@query(f"SELECT o_custkey::INT AS appid, month, (n * 1000)::DOUBLE AS avg_players, n::DOUBLE AS gain_loss, n + 0.5::DOUBLE AS gain_loss_percent, CASE WHEN n <> 2 THEN peak::DOUBLE END AS peak_players FROM ({CHARTED})")
def chart_tables(spark, d):
    """Each customer's orders as the page of a chart: a table among others with a head, rows by month, one twice, one too short."""
    month = F.date_format("o_orderdate", "MMMM yyyy")
    o = t(spark, d, "orders").groupBy("o_custkey", month.alias("month")).agg(F.count(F.lit(1)).alias("n"), F.floor(F.max("o_totalprice")).alias("peak"))
    peak = F.when(F.col("n") == 2, "no data").otherwise(F.col("peak").cast("string"))
    row = F.format_string("<tr><td>%s</td><td>0</td><td>0</td><td>0</td><td>0</td></tr><tr class='x'><td> %s </td><td>%d.000</td><td><b>+%d</b></td><td>+%d.5%%</td><td>%s</td></tr>", "month", "month", "n", "n", "n", peak)
    page = F.concat(F.lit("<html><table><tr><td>May 2020</td><td>1</td><td>1</td><td>1</td><td>1</td></tr></table><table class='a chart'><tr><th>Month</th></tr>"), F.array_join(F.collect_list(row), ""), F.lit("<tr><td>June 2021</td><td>1</td></tr><tr><td>Last 30 Days</td><td>1</td><td>1</td><td>1</td><td>1</td></tr></table></html>"))
    cells = o.groupBy(F.col("o_custkey").cast("int").alias("appid")).agg(page.alias("html")).select("appid", F.posexplode(L.table_cells(F.col("html"), "chart")).alias("position", "cells"))
    return L.monthly_players(cells)


@query("SELECT doc_id, action, md5(CASE action WHEN 'empty' THEN '' WHEN 'keep_en' THEN text WHEN 'short' THEN text ELSE lang || '>' || text END) AS english_md5 FROM (SELECT *, CASE WHEN coalesce(length(text),0) = 0 THEN 'empty' WHEN length(text) < 50 THEN 'short' WHEN lang = 'en' THEN 'keep_en' ELSE 'translate' END AS action FROM documents)")
def translate_documents(spark, d):
    """A translator that has no answer for short texts; run twice, the second time with one that must not be asked for others."""
    docs, cache = t(spark, d, "documents").select("doc_id", "lang", "text"), fresh(spark, "translations")
    mark = lambda rows: rows.select("digest", F.when(F.length("text") >= 50, F.concat_ws(">", "lang", "text")).alias("translated"))
    none = lambda rows: rows.select("digest", F.when(F.length("text") >= 50, F.lit("asked twice")).alias("translated"))
    Z.translate_stage(docs, "text", "lang", cache, mark)
    return Z.translate_stage(docs, "text", "lang", cache, none).select("doc_id", "action", F.md5("text").alias("english_md5"))


MARK = "SELECT user_id, max(ts) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1"


@query(f"SELECT event_id, e.user_id, ((row_number() OVER (PARTITION BY e.user_id ORDER BY ts DESC, event_id DESC) - 1) // 20)::INT AS page FROM events e LEFT JOIN ({MARK}) m ON m.user_id = e.user_id QUALIFY mark IS NULL OR ts > mark")
def pages_until_mark(spark, d):
    """Each user's events as recorded pages of 20 in JSON, the newest first, read down to the mark."""
    e = t(spark, d, "events")
    rank = F.row_number().over(L.Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))
    paged = e.withColumn("page", F.floor((rank - 1) / 20).cast("int")).groupBy("user_id", "page").agg(F.to_json(F.struct(F.collect_list(F.struct("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))).alias("items"))).alias("body"))
    pages = paged.select("user_id", "page", F.from_json("body", "items array<struct<event_id:bigint,at:bigint>>")["items"].alias("items"))
    marks = K.latest(e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), ["user_id"], "ts", []).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("mark"))
    return L.until_mark(pages, marks, "user_id", "page", "items", "at").select("event_id", "user_id", "page")


# --- news by day ------------------------------------------------------------------------------------------------------


@query("SELECT event_id::VARCHAR AS gid, event_type AS title, props AS contents, strftime(ts, '%Y-%m-%d') AS date, user_id::INT AS appid, strftime(ts, '%Y-%m-%d') AS updated_at FROM events")
def news_published(spark, d):
    """News land in partitions of their days; the first publishing takes all, a second one of a day adds nothing."""
    raw = t(spark, d, "events").select(F.col("event_id").cast("string").alias("gid"), F.col("event_type").alias("title"), F.concat(F.lit("<i>"), "props", F.lit("</i>")).alias("contents"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("date"), F.col("user_id").alias("appid"))
    trusted, published = fresh(spark, "news-trusted"), fresh(spark, "news-published")
    S.write_days(L.news(raw, DAY).withColumn("updated_at", F.col("date")), trusted, "updated_at")
    for day in (date(2024, 1, 15), date(2024, 1, 16)):
        P.publish_news(spark, trusted, published, day)
    return S.read_days(spark, published, P.NEWS, "updated_at")


# --- publishing -------------------------------------------------------------------------------------------------------

CHILD = 10_000_000


def trusted_rows(spark, d):
    """Parts as games since their first shipment, shipments as their add-ons."""
    li = t(spark, d, "lineitem")
    first = li.groupBy("l_partkey").agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("updated_at"))
    none = F.lit(None)
    games = t(spark, d, "part").join(first, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("p_partkey").cast("int").alias("appid"), F.lit("game").alias("type"), F.concat_ws(" ", "p_name", "p_brand", F.lit("™")).alias("name"), F.when(F.col("p_size") > 25, F.array(F.lit(1))).alias("dlc"),
        F.col("p_size").cast("int").alias("recommendations_total"), none.cast("struct<appid:int,name:string>").alias("fullgame"), F.array("p_type").alias("genres"), "updated_at",
    )
    children = li.select(
        (CHILD + F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("int").alias("appid"), F.lit("dlc").alias("type"), F.concat(F.lit("Part "), "l_linenumber").alias("name"), none.cast("array<int>").alias("dlc"),
        none.cast("int").alias("recommendations_total"), F.struct(F.col("l_partkey").cast("int").alias("appid"), none.cast("string").alias("name")).alias("fullgame"), none.cast("array<string>").alias("genres"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("updated_at"),
    )
    return games.unionByName(children)


CHILDREN = f"SELECT l_partkey, ({CHILD} + l_orderkey * 8 + l_linenumber)::INT AS id, l_shipdate FROM lineitem"
TITLES = f"""SELECT p_partkey, p_name || ' ' || p_brand || ' ™' AS name, p_type, refs, ids FROM part JOIN (SELECT l_partkey, count(DISTINCT id) AS refs, string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS ids FROM ({CHILDREN}) GROUP BY 1) ON p_partkey = l_partkey
  QUALIFY row_number() OVER (PARTITION BY lower(p_name || ' ' || p_brand) ORDER BY (p_size > 25)::INT DESC, refs DESC, p_size DESC, p_partkey DESC) = 1"""


@query(f"SELECT p_partkey::INT AS appid, name, refs AS n_dlc, ids AS dlc, p_type AS genres FROM ({TITLES})")
def publish_full_refresh(spark, d):
    ids = F.array_join(F.array_sort(F.transform("dlc", lambda x: x["appid"].cast("string"))), ",")
    return P.full_refresh(trusted_rows(spark, d)).select("appid", "name", F.size("dlc").cast("bigint").alias("n_dlc"), ids.alias("dlc"), F.array_join("genres", ",").alias("genres"))


@query(f"""SELECT p_partkey::INT AS appid, NULL::INT AS base_appid, p_name || ' ' || p_brand || ' ™' AS name FROM part JOIN (SELECT l_partkey, min(l_shipdate) AS since FROM lineitem GROUP BY 1) ON p_partkey = l_partkey WHERE since = DATE '1995-06-15'
  UNION ALL SELECT DISTINCT id, l_partkey::INT, 'Part ' || (id - {CHILD}) % 8 FROM ({CHILDREN}) WHERE l_shipdate = DATE '1995-06-15'""")
def publish_incremental(spark, d):
    games, children = P.incremental(trusted_rows(spark, d), date(1995, 6, 15))
    rows = children.select(F.col("dlc_doc.appid").alias("appid"), "base_appid", F.col("dlc_doc.name").alias("name"))
    return games.select("appid", F.lit(None).cast("int").alias("base_appid"), "name").unionByName(rows)


@query(f"SELECT count(*) AS n_left, count(*) AS n_right, 0::BIGINT AS only_left, 0::BIGINT AS only_right FROM ({TITLES})")
def rebuild_equals_incremental(spark, d):
    """The table brought forward in four steps, by the titles that each touches, against one built from all records."""
    trusted = settled(trusted_rows(spark, d), "trusted")
    table, since = P.rebuild(trusted, "1993-12-31"), "1993-12-31"
    for until in ("1995-06-15", "1996-12-31", "1997-12-31", "9999-12-31"):
        table, since = settled(P.refresh_titles(table, trusted, since, until), "published"), until
    return P.differences(P.rebuild(trusted, since), table)


# --- writes by key ----------------------------------------------------------------------------------------------------


def dirty_rows(spark, d):
    """Customers with orders as the old table; as new rows all customers, some under other keys, some twice, some with the name
    that the next one has."""
    c = t(spark, d, "customer")
    old = c.join(t(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.lit("old").alias("kept"))
    ahead = c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_name").alias("n"), F.col("c_nationkey").alias("a"))
    named = F.col("c_mktsegment") == "FURNITURE"
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey") + 10_000_000).otherwise(F.col("c_custkey"))
    new = c.join(ahead, "c_custkey", "left").select(key.alias("c_custkey"), F.when(named, F.col("n")).otherwise(F.col("c_name")).alias("c_name"), F.when(named, F.col("a")).otherwise(F.col("c_nationkey")).alias("c_nationkey"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    again = c.where("c_mktsegment = 'MACHINERY'").select("c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 2).alias("c_acctbal"))
    return old, new.unionByName(again).withColumn("kept", F.lit(None).cast("string"))


def _upsert_sql(steps: int = 16) -> str:
    """The last rule as one step each; more steps than a chain of names is long change nothing."""
    ctes = [
        "o AS (SELECT c_custkey AS k, c_name AS n, c_nationkey AS a, c_acctbal AS b FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))",
        """w AS (SELECT CASE WHEN c.c_mktsegment = 'BUILDING' THEN c.c_custkey + 10000000 ELSE c.c_custkey END AS k, CASE WHEN c.c_mktsegment = 'FURNITURE' THEN x.c_name ELSE c.c_name END AS n, CASE WHEN c.c_mktsegment = 'FURNITURE' THEN x.c_nationkey ELSE c.c_nationkey END AS a, c.c_acctbal + 1 AS b
          FROM customer c LEFT JOIN customer x ON x.c_custkey = c.c_custkey + 1 UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal + 2 FROM customer WHERE c_mktsegment = 'MACHINERY')""",
        "w1 AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY b DESC) = 1)",
        "g AS (SELECT w1.*, coalesce(o.k, p.m) AS old, CASE WHEN o.k IS NOT NULL THEN 1 WHEN p.m IS NOT NULL THEN 2 ELSE 3 END AS how FROM w1 LEFT JOIN o ON o.k = w1.k LEFT JOIN (SELECT n, a, min(k) AS m FROM o GROUP BY 1, 2) p ON p.n = w1.n AND p.a = w1.a)",
        "r0 AS MATERIALIZED (SELECT * FROM g QUALIFY old IS NULL OR row_number() OVER (PARTITION BY old ORDER BY how, b DESC, k DESC) = 1)",
    ]
    for i in range(steps):
        every = f"SELECT k, n, a, b, how FROM r{i} UNION ALL SELECT k, n, a, b, 0 FROM o WHERE k NOT IN (SELECT old FROM r{i} WHERE old IS NOT NULL)"
        ctes.append(f"l{i} AS MATERIALIZED (SELECT k FROM (SELECT *, row_number() OVER (PARTITION BY n, a ORDER BY how, b DESC, k DESC) AS rn FROM ({every}) WHERE n IS NOT NULL AND a IS NOT NULL) WHERE rn > 1 AND how > 0)")
        ctes.append(f"r{i + 1} AS MATERIALIZED (SELECT * FROM r{i} WHERE k NOT IN (SELECT k FROM l{i}))")
    return f"""WITH {", ".join(ctes)} SELECT coalesce(r.k, o.k) AS c_custkey, CASE WHEN r.k IS NULL THEN o.n ELSE r.n END AS c_name, CASE WHEN r.k IS NULL THEN o.a ELSE r.a END AS c_nationkey, round(CASE WHEN r.k IS NULL THEN o.b ELSE r.b END, 2) AS c_acctbal, CASE WHEN o.k IS NOT NULL THEN 'old' END AS kept FROM o FULL JOIN r{steps} r ON r.old = o.k"""


@query(_upsert_sql())
def upsert_three_step(spark, d):
    old, new = dirty_rows(spark, d)
    table, _ = K.upsert_three_step(old, new, "c_custkey", ["c_name", "c_nationkey"], ["kept"], [F.desc("c_acctbal"), F.desc("c_custkey")])
    return table.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT doc_id, md5(text) AS text_md5, CASE WHEN lang = 'en' THEN 'kept' ELSE 'moved' END AS done FROM documents")
def resume_work(spark, d):
    """Documents go through a step in two batches, the second after their language was looked at again: what the first batch did
    with a digest that still holds isn't done again."""
    docs, at = t(spark, d, "documents").select("doc_id", "lang", "text"), fresh(spark, "work")
    work = lambda rows: rows.select("doc_id", F.md5("text").alias("text_md5"), F.when(F.col("lang") == "en", "kept").otherwise("moved").alias("done"), "digest")
    earlier = docs.withColumn("lang", F.when(F.col("lang") == "fr", "en").otherwise(F.col("lang")))
    for rows in (earlier, docs, docs):
        W.process(rows, work, f"{at}/out", f"{at}/manifest", "step", "doc_id", ["lang"])
    return W.finished(spark, f"{at}/out", f"{at}/manifest", "step", "doc_id", "doc_id bigint, text_md5 string, done string, digest string").drop("digest")
