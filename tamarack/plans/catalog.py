"""Queries on text, types, keys and publishing, each with its SQL. models.py and zones.py hold the others."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import validate as V
from ..operators import keyed as K
from ..operators import publish as P
from ..operators import vectors as X
from . import landing as L
from .registry import ORACLE_SQL, QUERIES, query, t  # noqa: F401

NNAME = "lower(regexp_replace(regexp_replace(trim(p_name),'[™®]','','g'),'\\s+',' ','g'))"
RANKED = f"""SELECT p.*, {NNAME} AS nname, coalesce(r.refs, 0) AS refs,
  row_number() OVER (PARTITION BY {NNAME} ORDER BY (coalesce(r.refs,0) > 0)::INT DESC, (p_size > 25)::INT DESC, coalesce(r.refs,0) DESC, p_size::BIGINT DESC, p_partkey DESC) AS rn
  FROM part p LEFT JOIN (SELECT l_partkey, count(DISTINCT l_orderkey) AS refs FROM lineitem GROUP BY 1) r ON p_partkey = l_partkey"""


def ranked_parts(spark, d):
    parts = K.count_children(t(spark, d, "part"), t(spark, d, "lineitem"), "p_partkey", "l_partkey", "refs", distinct="l_orderkey")
    parts = parts.withColumns({"listed": (F.col("p_size") > 25).cast("int"), "votes": F.col("p_size").cast("long")})
    return P.rank_titles(parts, "p_name", "refs", "listed", "votes", "p_partkey").withColumn("nname", T.normalize_title(F.col("p_name")))


@query(f"SELECT p_partkey, nname, refs FROM ({RANKED}) WHERE rn = 1")
def winner_per_title(spark, d):
    return ranked_parts(spark, d).where("rn = 1").select("p_partkey", "nname", "refs")


@query(f"SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM ({RANKED}) WHERE rn = 1")
def winner_full_row(spark, d):
    return ranked_parts(spark, d).where("rn = 1").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query(f"SELECT DISTINCT l_partkey, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM ({RANKED}) WHERE rn = 1)")
def children_of_winners(spark, d):
    best = ranked_parts(spark, d).where("rn = 1").select(F.col("p_partkey").alias("l_partkey"))
    return K.attach_if_parent(t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity"), best, ["l_partkey"]).distinct()


@query("""SELECT c_custkey, coalesce(n, 0) AS n_children, coalesce(keys, '') AS child_keys FROM customer LEFT JOIN
  (SELECT o_custkey, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS keys FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def nest_children(spark, d):
    nested = K.nest(t(spark, d, "orders"), "o_custkey", "o_orderkey", ["o_orderstatus", "o_totalprice"], "children").withColumnRenamed("o_custkey", "c_custkey")
    out = K.attach_nested(t(spark, d, "customer").select("c_custkey"), nested, "c_custkey", "children")
    return out.select("c_custkey", F.size("children").cast("long").alias("n_children"), F.array_join(F.transform("children", lambda c: c["o_orderkey"].cast("string")), ",").alias("child_keys"))


@query("SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def child_count_default_zero(spark, d):
    return K.count_children(t(spark, d, "customer").select("c_custkey"), t(spark, d, "orders"), "c_custkey", "o_custkey", "n_orders")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def insert_only_new(spark, d):
    old = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return K.insert_only_new(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), old, ["o_orderkey"], [F.asc("o_custkey")])


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def dedup_keep_latest(spark, d):
    return K.keep_one(t(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("SELECT doc_id, md5(text) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY substr(source, 4)::INT, doc_id) = 1")
def dedup_keep_first_ranked_source(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.md5("text").alias("text_md5"), F.substring("source", 4, 9).try_cast("int").alias("part"))
    return K.keep_one(rows, ["text_md5"], [F.asc("part"), F.asc("doc_id")]).select("doc_id", "text_md5")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_md5, count(*) AS copies FROM documents GROUP BY text")
def dedup_full_text(spark, d):
    return K.distinct_texts(t(spark, d, "documents"), "text", "doc_id")


@query("SELECT event_id, user_id, event_type, '2024-01-15' AS updated_at FROM events WHERE ts::DATE = DATE '2024-01-15'")
def incremental_day(spark, d):
    day = date(2024, 1, 15)
    return t(spark, d, "events").where(K.of_day(F.col("ts"), day)).select("event_id", "user_id", "event_type", F.lit(day.isoformat()).alias("updated_at"))


@query("""SELECT e.event_id, e.user_id FROM events e JOIN (SELECT user_id, max(ts) AS hwm FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1) h ON e.user_id = h.user_id WHERE e.ts > h.hwm""")
def high_water_mark(spark, d):
    e = t(spark, d, "events")
    return K.above_mark(e, e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")), ["user_id"], "ts").select("event_id", "user_id")


@query("SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 1000 ELSE 9999 END::BIGINT AS item_limit FROM customer")
def limit_rule_by_history(spark, d):
    return K.limit_by_history(t(spark, d, "customer"), t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", 1000, 9999, "item_limit")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_difference_keys(spark, d):
    return K.set_difference(t(spark, d, "customer"), t(spark, d, "orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]).orderBy("c_custkey")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase') AND props IS NOT NULL AND props <> ''")
def key_type_filter(spark, d):
    return t(spark, d, "events").where(K.usable("event_type", "click", "purchase") & K.usable("props")).select("event_id", "event_type")


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS transcription FROM conversations GROUP BY 1")
def assemble_text(spark, d):
    return L.assemble(t(spark, d, "conversations"), "conv_id", "turn", "text", "transcription")


@query("SELECT p_partkey, trim(coalesce(p_name,'') || ' ' || coalesce(p_brand,'') || ' ' || coalesce(nullif(p_type, 'x'),'')) AS text FROM part")
def combine_fields(spark, d):
    return t(spark, d, "part").select("p_partkey", T.combine_fields(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("text"))


@query("SELECT doc_id, md5(lower(regexp_replace(regexp_replace(trim(text),'[™®]','','g'),'\\s+',' ','g'))) AS nname FROM documents")
def normalize_title(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(T.normalize_title(F.col("text"))).alias("nname"))


@query("SELECT page_id, regexp_replace(replace(url || ' ™ x', ' ', '_'), '[^0-9A-Za-z_-]', '', 'g') AS slug FROM pages")
def slugify(spark, d):
    return t(spark, d, "pages").select("page_id", T.slugify(F.concat("url", F.lit(" ™ x"))).alias("slug"))


@query("""SELECT p_partkey, CASE WHEN p_name = 'none' THEN 'x' ELSE replace(lower(trim(regexp_replace(trim(regexp_replace(p_name || ' Demo: a', '\\bdemo\\b', '', 'gi')), '[^\\w\\s-]', '', 'g'))), ' ', '-') END AS slug FROM part""")
def url_slug_name(spark, d):
    return t(spark, d, "part").select("p_partkey", T.url_slug_name(F.concat("p_name", F.lit(" Demo: a")), {"none": "x"}).alias("slug"))


MARKED = "'[b]x[/b] [*]http://a.b/c d {STEAM_CLAN}/i.png [url=q]' || html"


@query(f"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({MARKED},
  'https?://\\S+','','g'), '\\{{STEAM_[A-Z_]+\\}}/\\S*','','g'), '\\[\\*\\]','','g'), '\\[/\\*\\]','','g'), '\\[/?[a-zA-Z0-9]+(?:=[^\\]]+)?\\]','','g'), '<.*?>','','g'), '[ \\t]+',' ','g'), '\\s*\\n\\s*', chr(10), 'g'), ' ' || chr(10) || chr(9))) AS clean_md5 FROM pages""")
def strip_markup(spark, d):
    return t(spark, d, "pages").select("page_id", F.md5(T.squeeze(T.strip_markup(F.expr(MARKED)))).alias("clean_md5"))


@query(f"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  'https?://\\S+','','g'), '\\{{STEAM_[A-Z_]+\\}}/\\S*','','g'), '\\[\\*\\]','','g'), '\\[/\\*\\]','','g'), '\\[/?[a-zA-Z0-9]+(?:=[^\\]]+)?\\]','','g'), '<.*?>','','g'),
  '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '[ \\t]+',' ','g'), '\\s*\\n\\s*', chr(10), 'g'), ' ' || chr(10) || chr(9)) AS text_clean FROM pages""")
def clean_text_full(spark, d):
    return t(spark, d, "pages").select("page_id", T.clean_text(F.col("html")).alias("text_clean"))


@query("SELECT doc_id, CASE WHEN coalesce(length(text),0) = 0 THEN 'empty' WHEN length(text) < 50 THEN 'short' WHEN lang = 'en' THEN 'keep_en' ELSE 'translate' END AS action FROM documents")
def translate_route(spark, d):
    return t(spark, d, "documents").select("doc_id", T.translate_action(F.col("text"), F.col("lang")).alias("action"))


@query("""SELECT event_id, CASE WHEN esrb = 'e' THEN '3+' WHEN esrb = 'rp' THEN NULL WHEN esrb = 'm' THEN '17+' WHEN pegi = '12' THEN '12+' WHEN pegi = '16' THEN '16+' END AS age FROM
  (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'e' WHEN 1 THEN 'rp' WHEN 2 THEN 'm' ELSE 'zz' END AS esrb, CASE event_id % 3 WHEN 0 THEN '12' WHEN 1 THEN '16' ELSE '99' END AS pegi FROM events)""")
def age_rating_case(spark, d):
    e = t(spark, d, "events").select("event_id", F.expr("CASE event_id % 4 WHEN 0 THEN 'E' WHEN 1 THEN 'rp' WHEN 2 THEN 'M' ELSE 'zz' END AS esrb"), F.expr("CASE event_id % 3 WHEN 0 THEN '12' WHEN 1 THEN '16' ELSE '99' END AS pegi"))
    return e.select("event_id", V.age_rating(esrb=F.col("esrb"), pegi=F.col("pegi")).alias("age"))


DIRTY = "CASE event_id % 5 WHEN 0 THEN '-1' WHEN 1 THEN '16+' WHEN 2 THEN ' 17 ' WHEN 3 THEN NULL ELSE CAST(event_id % 150 AS VARCHAR(9)) END"


@query(f"""SELECT event_id, age, round(least(greatest(age::DOUBLE, 0), 100) / 100, 4) AS age_feature FROM
  (SELECT event_id, CASE WHEN TRY_CAST(trim(x) AS INT) >= 0 THEN TRY_CAST(trim(x) AS INT)::VARCHAR ELSE '0' END AS age FROM (SELECT event_id, {DIRTY} AS x FROM events))""")
def required_age_validate(spark, d):
    e = t(spark, d, "events").select("event_id", V.required_age(F.expr(DIRTY)).alias("age"))
    return e.withColumn("age_feature", F.round(V.age_feature(F.col("age")), 4))


@query("SELECT c_custkey, CASE WHEN x >= 0 THEN x END AS price, coalesce(x::VARCHAR, '') AS price_text FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE floor(c_acctbal)::BIGINT END AS x FROM customer)")
def price_validate(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(floor(c_acctbal) AS BIGINT) END").alias("x"))
    return c.select("c_custkey", V.price(F.col("x")).alias("price"), V.price_text(F.col("x")).alias("price_text"))


@query("SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, coalesce(json_extract_string(props, '$.none'), '') AS missing, substr(ts::VARCHAR, 1, 10) AS day FROM events")
def json_extract_defaults(spark, d):
    e = t(spark, d, "events").withColumn("j", F.from_json("props", "k bigint, none string"))
    return e.select("event_id", F.coalesce("j.k", F.lit(0)).alias("k"), F.coalesce("j.none", F.lit("")).alias("missing"), F.substring(F.col("ts").cast("string"), 1, 10).alias("day"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def epoch_to_date(spark, d):
    return t(spark, d, "events").select("event_id", V.epoch_date(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("date"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'Coming soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS release_date, strftime(o_orderdate, '%Y-%m') AS month FROM orders""")
def date_parse_or_raw(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "Coming soon").otherwise(F.date_format("o_orderdate", "MMM d, yyyy")).alias("x"), F.date_format("o_orderdate", "MMMM yyyy").alias("m"))
    return o.select("o_orderkey", V.release_date(F.col("x")).alias("release_date"), V.month(F.col("m")).alias("month"))


@query("""SELECT p_partkey, array_to_string(list_filter(list_transform([p_size::VARCHAR, ' ' || p_partkey::VARCHAR || ' ', p_name], lambda x: TRY_CAST(trim(x) AS INT)), lambda x: x IS NOT NULL), ',') AS ids FROM part""")
def array_parse_ints(spark, d):
    values = F.array(F.col("p_size").cast("string"), F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" ")), F.col("p_name"))
    return t(spark, d, "part").select("p_partkey", F.array_join(F.transform(V.int_array(values), lambda x: x.cast("string")), ",").alias("ids"))


@query("SELECT page_id FROM pages WHERE NOT (contains(url, 'DLC') OR contains(html, 'Expansion') OR contains(html, 'tion of'))")
def exclude_keyword_pages(spark, d):
    return t(spark, d, "pages").where(~(T.is_expansion_page(F.col("url"), F.col("html")) | F.col("html").contains("tion of"))).select("page_id")


@query("SELECT event_id, coalesce(x, -1)::BIGINT AS players FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 1000 END AS x FROM events)")
def poll_batch_sentinel(spark, d):
    polled = F.when(F.col("event_type") != "error", F.col("event_id") % 1000)
    return t(spark, d, "events").select("event_id", V.polled_players(polled).alias("players"))


@query("SELECT user_id, strftime(ts, '%Y-%m') AS month, round(avg(value), 2) AS avg_players, round(max(value), 2) AS peak_players, count(*) AS polls FROM events GROUP BY 1, 2")
def monthly_players(spark, d):
    return L.polls_by_month(t(spark, d, "events"), "user_id", "ts", "value")


@query("""WITH v AS (SELECT list_sort(list_distinct(flatten(list(string_split(p_type, ' '))))) AS v FROM part)
  SELECT p_partkey, array_to_string(list_transform(v, lambda x: CASE WHEN list_contains(string_split(p_type, ' '), x) THEN '1' ELSE '0' END), '') AS hot FROM part, v""")
def multi_hot(spark, d):
    p = t(spark, d, "part").withColumn("labels", F.split("p_type", " "))
    vocab = [r["label"] for r in X.vocabulary(p, "labels").orderBy("position").collect()]  # as many as there are labels
    return p.select("p_partkey", F.array_join(F.transform(X.multi_hot(F.col("labels"), vocab), lambda x: x.cast("string")), "").alias("hot"))


@query("SELECT vec_id, len(embedding) + 3 AS n, round(list_sum(embedding::DOUBLE[]) + label + 1.5, 4) AS total FROM embeddings")
def feature_concat(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", X.features(F.col("embedding"), F.array(F.col("label")), F.array(F.lit(1), F.lit(0.5))).alias("f"))
    return e.select("vec_id", F.size("f").cast("long").alias("n"), F.round(F.aggregate("f", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query("""SELECT vec_id, CASE WHEN label = 0 THEN 0.0 ELSE 1.0 END AS norm, CASE WHEN label = 0 THEN 0.0 ELSE round(embedding[1]::DOUBLE * label / sqrt(list_inner_product(list_transform(embedding, lambda x: x::DOUBLE * label), list_transform(embedding, lambda x: x::DOUBLE * label))), 4) END AS first FROM embeddings""")
def l2_normalize(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", X.l2_normalize(F.transform("embedding", lambda x: x.cast("double") * F.col("label"))).alias("u"))
    return e.select("vec_id", F.round(F.sqrt(X.inner_product(F.col("u"), F.col("u"))), 4).alias("norm"), (F.round(F.get("u", F.lit(0)), 4) + 0.0).alias("first"))


SIMILAR = "SELECT e.vec_id, e.label, round(list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 4) AS similarity FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) >= 0.2"


@query(f"SELECT vec_id, similarity FROM ({SIMILAR})")
def similar_items(spark, d):
    e = t(spark, d, "embeddings")
    return X.similar(e, e.where("vec_id = 0"), "embedding", "vec_id", 0.2).select("vec_id", F.round("similarity", 4).alias("similarity"))


@query()
def cluster_assign(spark, d):
    return X.fit_clusters(t(spark, d, "embeddings"), "embedding", 5)[1].select("vec_id", "cluster")


@query()
def silhouette_sweep(spark, d):
    scores = X.silhouette_sweep(t(spark, d, "embeddings"), "embedding")
    best = X.best_k(scores)
    return spark.createDataFrame([(k, s, k == best) for k, s in scores], "k int, silhouette_score double, best boolean")


@query("""WITH o AS (SELECT o_orderkey, l FROM orders LEFT JOIN (SELECT l_orderkey, list(DISTINCT l_linenumber) AS l FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1) ON l_orderkey = o_orderkey),
  m AS (SELECT l_orderkey, list(DISTINCT l_linenumber) AS m FROM lineitem WHERE l_linenumber >= 2 GROUP BY 1)
  SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_concat(coalesce(l, []), coalesce(m, [])))), ',') AS lines FROM o LEFT JOIN m ON l_orderkey = o_orderkey""")
def attach_children_set(spark, d):
    li = t(spark, d, "lineitem")
    first = li.where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_linenumber").alias("line"))
    old = t(spark, d, "orders").select("o_orderkey").join(first, "o_orderkey", "left")
    new = li.where("l_linenumber >= 2").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("line"))
    out = K.add_to_set(old, new, "o_orderkey", "line")
    return out.select("o_orderkey", F.array_join(F.transform(F.array_sort("line"), lambda x: x.cast("string")), ",").alias("lines"))


@query("""SELECT coalesce(d.doc_id, c.conv_id) AS doc_id, d.source, c.transcription FROM (SELECT doc_id, source FROM documents) d
  FULL JOIN (SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS transcription FROM conversations GROUP BY 1) c ON d.doc_id = c.conv_id""")
def merge_transcripts(spark, d):
    old = t(spark, d, "documents").select("doc_id", "source", F.lit(None).cast("string").alias("transcription"))
    return K.set_field(old, assemble_text(spark, d).withColumnRenamed("conv_id", "doc_id"), "doc_id", "transcription")


@query("SELECT o_custkey, max(o_orderdate) AS latest, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def latest_row_lookup(spark, d):
    return K.latest(t(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]).withColumnRenamed("o_orderdate", "latest")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 20")
def items_per_key_limit(spark, d):
    return K.keep_first(t(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 20).select("user_id", "event_id")


@query("SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-02')")
def skip_already_processed(spark, d):
    e = t(spark, d, "events")
    done = e.where((F.col("event_type") == "error") & (F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")))
    return e.join(K.keys_of(done, ["user_id"]), "user_id", "left_anti").select("event_id", "user_id", "event_type")


@query("SELECT p_partkey, TRY_CAST(regexp_replace('+' || p_size || '.000', '[.+%]', '', 'g') AS DOUBLE) AS players, TRY_CAST(regexp_replace('+' || p_size || '.5%', '[+%]', '', 'g') AS DOUBLE) AS percent, TRY_CAST(regexp_replace(p_name, '[.+%]', '', 'g') AS DOUBLE) AS bad FROM part")
def chart_numbers(spark, d):
    n = F.concat(F.lit("+"), F.col("p_size").cast("string"))
    return t(spark, d, "part").select("p_partkey", V.chart_number(F.concat(n, F.lit(".000"))).alias("players"), V.chart_percent(F.concat(n, F.lit(".5%"))).alias("percent"), V.chart_number(F.col("p_name")).alias("bad"))


@query("SELECT 'label' || label AS label_name, count(*) AS n FROM embeddings GROUP BY 1 UNION ALL SELECT 'lang' || lang, count(*) FROM documents GROUP BY 1")
def union_by_name(spark, d):
    a = t(spark, d, "embeddings").groupBy(F.concat(F.lit("label"), F.col("label")).alias("label_name")).agg(F.count(F.lit(1)).alias("n"))
    b = t(spark, d, "documents").groupBy(F.concat(F.lit("lang"), F.col("lang")).alias("label_name")).agg(F.count(F.lit(1)).alias("n"))
    return K.union_all([a, b])
