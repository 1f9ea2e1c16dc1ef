"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is WINDOW consecutive words of an item (an item of fewer words is one window). Of the hashes of the K-word grams
in a window the least is its fingerprint; every window of a document whose fingerprint is one of the benchmark's is a hit
to be extended: its words are held against the benchmark's windows. As a window's fingerprint depends on its words alone,
every shared window is found, and equal words decide, not hashes. Windows of short items are looked up by the hash of all
their words.

The benchmark's fingerprints are put into the plan as a constant set only while there are at most MAX_LITERALS of them; a
larger benchmark is joined by fingerprint, the windows of each document being exploded once.

Defined results: a null or empty text has no words, no hits and isn't contaminated; an item without words occurs nowhere;
a null item_id counts for n_hit, but isn't listed; items that share an item_id count once; a document shorter than a window
can be hit by short items only; repeated documents each return a row; an empty table of documents returns no rows, an empty
benchmark hits nothing; columns of other names don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

WINDOW, K = 10, 5
MAX_LITERALS = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BREAKS), "")


def _grams(hashes: Column, size: int) -> Column:
    """Hash of the size values from each place on; empty if there are fewer."""
    many = F.size(hashes) - size
    at = F.when(many >= 0, F.sequence(F.lit(0), F.greatest(many, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))


def _least(values: Column, span: int) -> Column:
    """Least of span values from each place on that has so many."""
    many = F.size(values) - span
    at = F.when(many >= 0, F.sequence(F.lit(0), F.greatest(many, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.least(*[F.get(values, i + k) for k in range(span)]))


def with_fingerprints(rows: DataFrame, text: str, short: list[int]) -> DataFrame:
    """rows with __words, and __f10, __f<length>...: the fingerprint of the window at each word."""
    rows = rows.withColumn("__words", words_of(F.col(text)))
    rows = rows.withColumn("__h", F.transform("__words", lambda w: F.xxhash64(w)))
    rows = rows.withColumns({"__g": _grams(F.col("__h"), K), **{f"__f{n}": _grams(F.col("__h"), n) for n in short}})
    return rows.withColumn(f"__f{WINDOW}", _least(F.col("__g"), WINDOW - K + 1)).drop("__h", "__g")


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """window (words joined by spaces), size, fp, items (sorted ids as strings), one row for each distinct window."""
    rows = materialize(items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")), "benchmark-words").where("size(words) > 0")
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0))))
    rows = rows.select("item", F.least(F.size("words"), F.lit(WINDOW)).alias("size"), "words", at.alias("at")).select("item", "size", F.slice("words", F.col("at") + 1, WINDOW).alias("w"))
    # the same hashes as with_fingerprints gives, written out for one window
    rows = rows.select("item", "size", F.array_join("w", " ").alias("window"), *[F.xxhash64(F.get("w", F.lit(k))).alias(f"h{k}") for k in range(WINDOW)])
    gram = lambda k, n: F.xxhash64(*[F.col(f"h{i}") for i in range(k, k + n)])
    fp = F.least(*[gram(k, K) for k in range(WINDOW - K + 1)])
    for n in range(1, WINDOW):
        fp = F.when(F.col("size") == n, gram(0, n)).otherwise(fp)
    every = rows.select("item", "size", "window", fp.alias("fp"))
    return every.groupBy("window", "size", "fp").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _hits(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """rows with __n (words) and __hits: array of (at, size, window) of windows whose fingerprint the benchmark has."""
    prints = windows.select("size", "fp").distinct()
    known = prints.limit(MAX_LITERALS + 1).collect()
    short = sorted({r["size"] for r in (known if len(known) <= MAX_LITERALS else prints.select("size").distinct().collect())} - {WINDOW})
    sizes = [*short, WINDOW]
    if len(known) <= MAX_LITERALS:
        rows = with_fingerprints(rows, "__text", short)
        for n in sizes:
            values = ",".join(str(r["fp"]) for r in known if r["size"] == n) or "NULL"
            rows = rows.withColumn(f"__at{n}", F.expr(f"array_compact(transform(__f{n}, (f, i) -> IF(f IN ({values}), i, NULL)))"))
    else:  # row numbers are given once and written, so that both sides of the join have the same
        rows = materialize(with_fingerprints(rows.withColumn("__row", F.monotonically_increasing_id()), "__text", short), "decontaminate")
        every = reduce(DataFrame.unionByName, [rows.select("__row", F.lit(n).alias("size"), F.explode(F.array_distinct(f"__f{n}")).alias("fp")) for n in sizes])
        met = every.join(prints, ["size", "fp"]).groupBy("__row").agg(F.collect_list(F.struct("size", "fp")).alias("__met"))
        rows = rows.join(met, "__row", "left")
        for n in sizes:
            own = F.expr(f"transform(filter(__met, m -> m.size = {n}), m -> m.fp)")
            rows = rows.withColumn("__own", F.coalesce(own, F.array().cast("array<bigint>")))
            rows = rows.withColumn(f"__at{n}", F.expr(f"IF(size(__own) = 0, CAST(array() AS array<int>), array_compact(transform(__f{n}, (f, i) -> IF(array_contains(__own, f), i, NULL))))")).drop("__own")
    found = [F.expr(f"transform(__at{n}, i -> struct(i AS at, {n} AS size, array_join(slice(__words, i + 1, {n}), ' ') AS window))") for n in sizes]
    number = {} if "__row" in rows.columns else {"__row": F.monotonically_increasing_id()}
    return rows.withColumns({"__n": F.size("__words").cast("long"), "__hits": F.concat(*found), **number}).drop("__words", *[f"__{x}{n}" for n in sizes for x in ("f", "at")], "__met")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_hit, n_items, item_list (sorted ids) for each row of docs."""
    windows = materialize(benchmark_windows(items), "benchmark-windows")
    rows = _hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text")), windows).select("__row", "id", "__n", F.explode_outer("__hits").alias("__hit"))
    # a row without hits gets a key of its own, so that these rows don't meet in one task
    rows = rows.select("__row", "id", "__n", F.col("__hit.at").alias("at"), F.col("__hit.size").alias("size"), F.coalesce("__hit.window", F.concat(F.lit("\0"), F.col("__row").cast("string"))).alias("window"))
    met = rows.join(windows.drop("fp"), ["window", "size"], "left")
    spans = F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "size")))
    per = met.groupBy("__row", "id", "__n").agg(F.array_sort(spans).alias("spans"), F.collect_set("items").alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["at"] + s["size"]).cast("long").alias("end"),
            (acc["total"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(acc["end"], s["at"]))).cast("long").alias("total"),
        ),
        lambda acc: acc["total"],
    )
    listed = F.array_sort(F.array_distinct(F.flatten("items")))
    return per.select("id", F.col("__n").alias("n_words"), covered.alias("n_hit"), listed.alias("item_list")).select("id", "n_words", "n_hit", F.size("item_list").cast("long").alias("n_items"), "item_list")


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs in which no window of the benchmark stands, with their columns."""
    windows = materialize(benchmark_windows(items), "benchmark-windows")
    rows = _hits(docs.withColumn("__text", F.col(text_col)), windows)
    if windows.count() <= MAX_LITERALS:
        # a small benchmark: held against its windows where the row stands, so that no text moves
        known = [r["window"] for r in windows.select("window").distinct().collect()]
        # the row number in the flag keeps the filter above the projections, whose arrays it would else make anew per element
        clean = (F.monotonically_increasing_id() >= 0) & ~F.exists("__hits", lambda h: h["window"].isin(known))
        return rows.withColumn("__clean", clean).where("__clean").select(*docs.columns)
    bad = rows.select("__row", F.explode("__hits").alias("h")).select("__row", "h.window", "h.size").join(windows, ["window", "size"], "left_semi").select("__row").distinct()
    return rows.join(bad, "__row", "left_anti").select(*docs.columns)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_list"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
