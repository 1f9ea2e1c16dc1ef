"""Queries on vectors, features, models and languages."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features as M
from ..operators import language as G
from ..operators import vectors as X
from ..sources.shared import fresh
from .registry import query, t

DOT = "list_inner_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"
BATCH = f"SELECT q.vec_id AS query, e.vec_id AS key, round({DOT}, 6) + 0.0 AS similarity FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 100 = 0) q"


def batch(spark, d, **options):
    e = t(spark, d, "embeddings")
    return X.search(e, e.where("vec_id % 100 = 0"), "embedding", "vec_id", **options)


@query(f"SELECT query, key AS vec_id, similarity, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, key)::INT AS rank FROM ({BATCH}) QUALIFY rank <= 10")
def similar_items_batch(spark, d):
    return batch(spark, d, top=10).select("query", F.col("key").alias("vec_id"), "similarity", "rank")


@query(f"""SELECT CASE WHEN i.lang <> 'en' THEN query END AS input_appid, i.source || '-' || query AS input_name, trim(i.lang || ' ' || '' || ' ' || i.source) AS input_description, i.lang || '; ' || i.source AS input_genres, '' AS input_categories,
  key AS similar_appid, s.source AS similar_name, e.label AS cluster, round(similarity, 4) AS similarity
  FROM ({BATCH}) JOIN documents i ON i.doc_id = query JOIN documents s ON s.doc_id = key JOIN embeddings e ON e.vec_id = key WHERE similarity >= 0.25""")
def similarity_report(spark, d):
    docs, blank = t(spark, d, "documents"), F.lit(None).cast("string")
    genres, nothing = F.array("lang", "source"), F.array().cast("array<string>")
    inputs = docs.select(F.col("doc_id").alias("query"), F.concat_ws("-", "source", "doc_id").alias("name"), X.T.combine_fields(F.col("lang"), blank, F.col("source")).alias("description"), genres.alias("genres"), nothing.alias("categories"), (F.col("lang") != "en").alias("listed"))
    items = t(spark, d, "embeddings").join(docs, F.col("doc_id") == F.col("vec_id")).select(F.col("vec_id").alias("key"), F.col("source").alias("name"), F.col("label").alias("cluster"))
    return X.similarity_report(batch(spark, d, threshold=0.25), inputs, items)


# --- features ---------------------------------------------------------------------------------------------------------

MASK = "4294967295"


def _rotl(x: str, r: int) -> str:
    return f"(((({x}) << {r}) | (({x}) >> {32 - r})) & {MASK})"


def _murmur3(term: str) -> str:
    """The standard 32-bit hash of a term's bytes with seed 42, as an expression over whole numbers."""
    byte = lambda i: f"substr(hx, ({i}) * 2 + 1, 2)"
    block = f"('0x' || {byte('4 * i + 3')} || {byte('4 * i + 2')} || {byte('4 * i + 1')} || {byte('4 * i')})::UBIGINT"
    mixed = lambda k: f"({_rotl(f'({k}) * 3432918353 & {MASK}', 15)} * 461845907 & {MASK})"
    body = f"list_reduce(list_prepend(42::UBIGINT, list_transform(range(n // 4), lambda i: {mixed(block)})), lambda h, k: ({_rotl('xor(h, k)', 13)} * 5 + 3864292196) & {MASK})"
    rest = f"CASE WHEN n % 4 = 0 THEN 0 ELSE {mixed(f'''('0x' || CASE WHEN n % 4 > 2 THEN {byte('n - n % 4 + 2')} ELSE '' END || CASE WHEN n % 4 > 1 THEN {byte('n - n % 4 + 1')} ELSE '' END || {byte('n - n % 4')})::UBIGINT''')} END"
    a = f"SELECT term, xor(xor({body}, {rest}), n::UBIGINT) AS h FROM (SELECT term, hex(encode(term)) AS hx, octet_length(encode(term)) AS n FROM ({term}))"
    b = f"SELECT term, xor(h, h >> 16) * 2246822507 & {MASK} AS h FROM ({a})"
    c = f"SELECT term, xor(h, h >> 13) * 3266489909 & {MASK} AS h FROM ({b})"
    return f"SELECT term, (xor(h, h >> 16) % {M.BUCKETS})::INT AS bucket FROM ({c})"


def _counted(where: str) -> str:
    """words: bucket and count of each document; idf over the documents that the condition names, m of them."""
    return f"""w AS MATERIALIZED (SELECT doc_id, unnest(string_split_regex(lower(trim(coalesce(lang, '') || ' ' || coalesce(text, ''))), '{M.GAPS}')) AS term FROM documents),
  hashed AS MATERIALIZED ({_murmur3("SELECT DISTINCT term FROM w WHERE term <> ''")}),
  tf AS MATERIALIZED (SELECT doc_id, bucket, count(*) AS n FROM w JOIN hashed USING (term) GROUP BY 1, 2),
  m AS (SELECT count(*) AS m FROM documents WHERE {where}), idf AS (SELECT bucket, ln((m + 1) / (count(*) + 1)) AS idf FROM tf, m WHERE {where} GROUP BY bucket, m),
  f AS (SELECT doc_id, md5(string_agg(bucket || ':' || n, ',' ORDER BY bucket)) AS words_md5, sum(n)::BIGINT AS n_words, sum((n * coalesce(idf, ln(m + 1))) ** 2) AS square FROM tf JOIN m ON true LEFT JOIN idf USING (bucket) GROUP BY 1)"""


def _items(spark, d):
    docs = t(spark, d, "documents")
    return docs.select("doc_id", "lang", "text", F.array("lang").alias("genres"), F.array("source", "lang").alias("categories"), F.col("n_chars").alias("required_age"))


def _shown(rows):
    """The words of a vector as 'bucket:count' in order, and its length."""
    counts = F.transform(vector_to_array("words", "float32"), lambda x, i: F.when(x != 0, F.concat_ws(":", i, x.cast("int"))))
    raw = vector_to_array("features_raw")
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, x: s + x * x))
    return rows.select("doc_id", F.array_compact(counts).alias("counts"), raw.alias("raw"), norm.alias("norm")).select(
        "doc_id", F.when(F.size("counts") > 0, F.md5(F.array_join("counts", ","))).alias("words_md5"),
        F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + F.split_part(x, F.lit(":"), F.lit(2)).cast("long")).alias("n_words"), "raw", "norm",
    )


@query(f"WITH {_counted('true')} SELECT doc_id, words_md5, coalesce(n_words, 0) AS n_words, round(sqrt(coalesce(square, 0)), 4) AS norm FROM documents LEFT JOIN f USING (doc_id)")
def text_features(spark, d):
    items = _items(spark, d)
    model = M.feature_pipeline(items, ["lang", "text"], [], "NULL")
    rows = _shown(model.transform(items))
    return rows.select("doc_id", "words_md5", "n_words", F.round("norm", 4).alias("norm"))


KNOWN = "doc_id IN (SELECT doc_id FROM labels)"


@query(f"""WITH {_counted(KNOWN)}, g AS (SELECT list_sort(list(DISTINCT lang)) AS g, list_sort(list_distinct(list_concat(list(lang), list(source)))) AS c FROM documents WHERE {KNOWN}),
  h AS (SELECT doc_id, list_transform(g, lambda x: (x = lang)::INT) AS hg, list_transform(c, lambda x: (x = source OR x = lang)::INT) AS hc, least(n_chars, 100) / 100 AS age FROM documents, g WHERE NOT {KNOWN})
  SELECT doc_id, words_md5, coalesce(n_words, 0) AS n_words, array_to_string(hg, '') AS genres, array_to_string(hc, '') AS categories, age, ({M.BUCKETS} + len(hg) + len(hc) + 1)::INT AS width, round(sqrt(coalesce(square, 0) + list_sum(hg) + list_sum(hc) + age ** 2), 4) AS norm FROM h LEFT JOIN f USING (doc_id)""")
def new_item_features(spark, d):
    """Documents without a label go through the pipeline that those with one fitted."""
    items, known = _items(spark, d), t(spark, d, "labels").select("doc_id")
    model = M.feature_pipeline(items.join(known, "doc_id", "left_semi"), ["lang", "text"], ["genres", "categories"], "required_age")
    wide = {c: len(v) for c, v in M.vocabularies(model).items()}
    rows = _shown(model.transform(items.join(known, "doc_id", "left_anti")))
    hot = lambda at, n: F.array_join(F.transform(F.slice("raw", M.BUCKETS + 1 + at, n), lambda x: x.cast("int").cast("string")), "")
    return rows.select(
        "doc_id", "words_md5", "n_words", hot(0, wide["genres"]).alias("genres"), hot(wide["genres"], wide["categories"]).alias("categories"),
        F.element_at("raw", -1).alias("age"), F.size("raw").alias("width"), F.round("norm", 4).alias("norm"),
    )


@query()
def new_item_clusters(spark, d):
    """Documents with a label train features and clusters; the run is saved, read back and classifies the others."""
    items, known, folder = _items(spark, d), t(spark, d, "labels").select("doc_id"), fresh(spark, "runs")
    train = items.join(known, "doc_id", "left_semi")
    model, scores = M.fit_best(train, M.feature_pipeline(train, ["lang", "text"], ["genres", "categories"], "required_age"), range(5, 8))
    M.save_run(model, scores, train, folder, "first", "doc_id", "lang")
    return M.load_run(spark, folder)[0].transform(items.join(known, "doc_id", "left_anti")).select("doc_id", "cluster")


# --- languages --------------------------------------------------------------------------------------------------------

#: Texts are cut into stretches first, as a place far into a text is dear.
TRIGRAMS = """x AS (SELECT doc_id, lang, regexp_replace(lower(text), '[ \\t\\n\\r\\f]+', ' ', 'g') AS x FROM documents),
  y AS (SELECT doc_id, lang, substring(x, o, 102) AS x, least(100, length(x) - 1 - o) AS n FROM (SELECT doc_id, lang, x, unnest(range(1, length(x) - 1, 100)) AS o FROM x)),
  c AS MATERIALIZED (SELECT doc_id, lang, unnest(list_transform(range(1, n + 1), lambda i: substring(x, i, 3))) AS gram FROM y)"""


def _language(where: str) -> str:
    return f"""{TRIGRAMS}, n AS (SELECT lang, gram, count(*) AS n FROM c WHERE {where} GROUP BY 1, 2),
  best AS (SELECT gram, sum(n) AS every FROM n GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {G.GRAMS}), v AS (SELECT sum(every) AS total, count(*) AS v FROM best),
  l AS (SELECT lang, sum(n) AS here FROM n JOIN best USING (gram) GROUP BY 1),
  model AS MATERIALIZED (SELECT gram, lang, floor(1000 * ln((coalesce(n, 0) + 1.0::DOUBLE) / (every - coalesce(n, 0) + 1.0::DOUBLE) * ((total - here + v) / (here + v)::DOUBLE)))::INT AS weight FROM best CROSS JOIN l LEFT JOIN n USING (gram, lang), v)"""


@query(f"WITH {_language('true')} SELECT gram, lang, weight FROM model")
def language_model(spark, d):
    return G.fit(t(spark, d, "documents"), "text", "lang").select("gram", "lang", "weight")


@query(f"""WITH {_language(KNOWN)}, s AS (SELECT doc_id, m.lang, sum(weight) AS s FROM c JOIN model m USING (gram) WHERE NOT {KNOWN} GROUP BY 1, 2)
  SELECT doc_id, documents.lang, s.lang AS detected FROM documents LEFT JOIN (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) = 1) s USING (doc_id) WHERE NOT {KNOWN}""")
def language_detect(spark, d):
    """Fitted on the documents with a label, applied to all others."""
    docs, known = t(spark, d, "documents"), t(spark, d, "labels").select("doc_id")
    model = G.fit(docs.join(known, "doc_id", "left_semi"), "text", "lang")
    return G.detect(docs.join(known, "doc_id", "left_anti"), model, "text").select("doc_id", "lang", "detected")
