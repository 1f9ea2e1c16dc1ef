"""Publishing: one winner for each title with its children embedded (full refresh), or the day's rows (incremental)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_title
from ..sources.shared import settled
from ..sources.sinks import append_days, read_days, table_exists
from .keyed import any_order, attach_nested, count_children, insert_only_new, keep_one, nest, upsert_three_step

#: The published columns in their order; children carry the id of their parent in place of the array.
COLUMNS = [
    "appid", "type", "name", "required_age", "is_free", "controller_support", "detailed_description", "about_the_game",
    "short_description", "supported_languages", "legal_notice", "pc_requirements", "mac_requirements", "linux_requirements",
    "developers", "publishers", "platforms", "categories", "genres", "release_date", "recommendations_total", "metacritic_score",
]


#: Types of the published columns that aren't text, for those that a table lacks.
TYPES = dict.fromkeys(("appid", "fullgame_appid", "base_appid", "recommendations_total", "metacritic_score"), "int")
TYPES |= dict.fromkeys(("developers", "publishers", "categories", "genres"), "array<string>") | {"is_free": "boolean", "platforms": "struct<windows:boolean,mac:boolean,linux:boolean>"}
TYPES |= dict.fromkeys(("pc_requirements", "mac_requirements", "linux_requirements"), "struct<minimum:string,recommended:string>")


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with these columns in this order; missing ones are null, of the type that they have elsewhere."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(TYPES.get(c, "string")).alias(c) for c in columns])


def load_candidates(trusted: DataFrame, run_date: date | None = None) -> DataFrame:
    """Named games and add-ons; of one day if run_date is given."""
    rows = trusted.where(F.col("name").isNotNull() & (F.col("name") != "") & F.col("type").isin("game", "dlc"))
    if run_date:
        rows = rows.where(F.col("updated_at") == F.lit(run_date.isoformat()))
    rows = rows.withColumn("appid", F.col("appid").cast("string").try_cast("int")).withColumn("fullgame_appid", F.col("fullgame.appid").cast("string").try_cast("int"))
    for c in ("dlc", "categories", "genres", "developers", "publishers"):
        if c in rows.columns:
            rows = rows.withColumn(c, F.coalesce(c, F.array().cast(rows.schema[c].dataType)))
    return rows


def winners(rows: DataFrame) -> DataFrame:
    """One game for each normalised title: referenced by add-ons first, then listing add-ons, more references, more
    recommendations, the larger id."""
    children = rows.where("type = 'dlc' AND fullgame_appid IS NOT NULL")
    games = count_children(rows.where("type = 'game'"), children, "appid", "fullgame_appid", "__refs", distinct="appid")
    listed = F.size("dlc") > 0 if "dlc" in rows.columns else F.lit(False)
    games = games.withColumns({"__listed": listed.cast("int"), "__votes": F.coalesce(F.col("recommendations_total").cast("long"), F.lit(0))})
    return rank_titles(games, "name", "__refs", "__listed", "__votes", "appid").where("rn = 1").drop("rn", "__refs", "__listed", "__votes")


def full_refresh(trusted: DataFrame, repoint: bool = False, unique: bool = False) -> DataFrame:
    """The whole published table. Children of a game that isn't its title's winner are dropped; with repoint they go to the
    winner. unique: each (type, appid) stands once, so that a child needn't be looked for twice."""
    rows = load_candidates(trusted)
    best = winners(rows).drop("dlc")
    children = rows.where("type = 'dlc' AND fullgame_appid IS NOT NULL").withColumn("base_appid", F.col("fullgame_appid"))
    if repoint:
        titles = best.select(normalize_title(F.col("name")).alias("__title"), F.col("appid").alias("__winner"))
        games = rows.where("type = 'game'").select(F.col("appid").alias("__game"), normalize_title(F.col("name")).alias("__title")).join(titles, "__title").drop("__title")
        children = children.join(games, F.col("fullgame_appid") == F.col("__game")).withColumn("base_appid", F.col("__winner")).drop("__game", "__winner")
    if not unique:
        children = keep_one(children, ["base_appid", "appid"], [F.desc("updated_at"), F.desc("name")])
    # the winners' side is narrow; whether it is broadcast is the planner's choice by its size
    children = children.join(best.select(F.col("appid").alias("base_appid")), "base_appid", "left_semi")
    embedded = nest(conform(children, [*COLUMNS, "fullgame_appid", "base_appid"]), "base_appid", "appid", [*COLUMNS, "fullgame_appid"], "dlc")
    return attach_nested(conform(best, COLUMNS), embedded.withColumnRenamed("base_appid", "appid"), "appid", "dlc")


def current(trusted: DataFrame) -> DataFrame:
    """The last version of each record by (type, appid)."""
    # the columns themselves are a total order; as JSON they'd be shuffled and sorted a second time, so only maps, which have none, are
    maps = [x.name for x in trusted.schema if "map<" in x.dataType.simpleString()]
    order = [F.desc(c) for c in trusted.columns if c not in ("type", "appid", "updated_at", *maps)]
    return keep_one(trusted, ["type", "appid"], [F.desc("updated_at"), *order, *(any_order(maps) if maps else [])])


def rebuild(trusted: DataFrame, until: str, repoint: bool = False) -> DataFrame:
    """The published table from all records up to a day."""
    return full_refresh(current(load_candidates(trusted.where(F.col("updated_at") <= until))), repoint, unique=True)


def refresh_titles(published: DataFrame, trusted: DataFrame, since: str, until: str, repoint: bool = False) -> DataFrame:
    """published, brought from day since to day until so that it equals a rebuild: only titles that the records of these days
    touch are computed anew, from all their records. Touched are the titles of each version of a game that came, and of the games
    that any version of a child that came belongs to. Untouched rows are read once and copied."""
    rows = load_candidates(trusted.where(F.col("updated_at") <= until))
    came = rows.where(F.col("updated_at") > since).select("type", "appid")
    games = rows.where("type = 'game'").withColumn("__title", normalize_title(F.col("name")))
    children = rows.where("type = 'dlc' AND fullgame_appid IS NOT NULL")
    parents = children.join(came.where("type = 'dlc'").select("appid").distinct(), "appid", "left_semi").select(F.col("fullgame_appid").alias("appid"))
    ids = parents.unionByName(came.where("type = 'game'").select("appid")).distinct()
    touched = settled(games.join(ids, "appid", "left_semi").select("__title").distinct(), "titles")
    # a game that left a title has a version there, so the versions of these titles' games hold all that the titles need
    own = games.join(touched, "__title", "left_semi").select("appid").distinct()
    part = games.drop("__title").join(own, "appid", "left_semi")
    theirs = children.join(own.withColumnRenamed("appid", "fullgame_appid"), "fullgame_appid", "left_semi").select("appid").distinct()
    every = rows.where("type = 'dlc'")  # a child's last version may name no game
    part = part.unionByName(every.join(theirs, "appid", "left_semi").select(*part.columns))
    anew = full_refresh(current(part), repoint, unique=True).withColumn("__title", normalize_title(F.col("name")))
    anew = anew.join(touched, "__title", "left_semi").drop("__title")  # titles that a touched game moved from or to are all touched
    kept = published.withColumn("__title", normalize_title(F.col("name"))).join(touched, "__title", "left_anti").drop("__title")
    return kept.unionByName(anew)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows each has, and how many of them the other lacks (repeated rows count as often as they stand)."""
    sides = [df.select(*left.columns, F.lit(n).alias("__l"), F.lit(1 - n).alias("__r")) for df, n in ((left, 1), (right, 0))]
    # one aggregate over both sides: each is computed and shuffled once
    rows = sides[0].unionAll(sides[1]).groupBy(*left.columns).agg(F.sum("__l").alias("l"), F.sum("__r").alias("r"))
    sums = {"n_left": F.col("l"), "n_right": F.col("r"), "only_left": F.greatest(F.col("l") - F.col("r"), F.lit(0)), "only_right": F.greatest(F.col("r") - F.col("l"), F.lit(0))}
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name) for name, c in sums.items()])


def attach_children(published: DataFrame, children: DataFrame, union: bool = False) -> DataFrame:
    """published with children (base_appid, dlc_doc) added to their games' dlc. A child with the id of one that is there takes its
    place; with union it is added beside it unless it is equal. Children of games that aren't published are left out."""
    more = children.groupBy(F.col("base_appid").alias("__base")).agg(F.array_sort(F.collect_set("dlc_doc") if union else F.collect_list("dlc_doc")).alias("__more"))
    none = F.array().cast(published.schema["dlc"].dataType)
    old, new = F.coalesce("dlc", none), F.coalesce("__more", none)
    ids = F.transform(new, lambda x: x["appid"])
    both = F.array_union(old, new) if union else F.concat(F.filter(old, lambda x: ~F.array_contains(ids, x["appid"])), new)
    return published.join(more, F.col("appid") == F.col("__base"), "left").withColumn("dlc", F.array_sort(both)).drop("__base", "__more")


def apply_incremental(published: DataFrame, trusted: DataFrame, run_date: date, union: bool = False) -> tuple[DataFrame, DataFrame]:
    """The day's games by the three steps and the day's children attached; and the conflicts."""
    games, children = incremental(trusted, run_date)
    table, conflicts = upsert_three_step(published, games, "appid", ["name", "type"], ["dlc"])
    return attach_children(table, children, union), conflicts


def incremental(trusted: DataFrame, run_date: date) -> tuple[DataFrame, DataFrame]:
    """The day's games and the day's children as (base_appid, dlc_doc), the latest of each."""
    rows = load_candidates(trusted, run_date)
    games = keep_one(rows.where("type = 'game'"), ["appid"], [F.desc("name")])
    children = rows.where("type = 'dlc' AND fullgame_appid IS NOT NULL").withColumn("base_appid", F.col("fullgame_appid"))
    children = conform(keep_one(children, ["base_appid", "appid"], [F.desc("name")]), [*COLUMNS, "fullgame_appid", "base_appid"])
    return conform(games, COLUMNS), children.select("base_appid", F.struct(*COLUMNS, "fullgame_appid").alias("dlc_doc"))


def rank_titles(items: DataFrame, name: str, refs: str, listed: str, votes: str, key: str) -> DataFrame:
    """items with rn, their rank within the normalised title."""
    w = Window.partitionBy(normalize_title(F.col(name))).orderBy(F.desc((F.col(refs) > 0).cast("int")), F.desc(listed), F.desc(refs), F.desc(votes), F.desc(key))
    return items.withColumn("rn", F.row_number().over(w))


#: Published news in their order, with their types.
NEWS = "gid string, title string, contents string, date string, appid int, updated_at string"


def publish_news(spark: SparkSession, trusted: str, published: str, run_date: date) -> None:
    """Appends news whose gid the published table lacks: all trusted ones if nothing is published yet, else those of the day, of
    whose partition alone the files are read. Of several rows with one gid the latest counts. A second run appends nothing."""
    first = not table_exists(spark, published)
    rows = read_days(spark, trusted, NEWS, "updated_at", None if first else run_date)
    old = read_days(spark, published, NEWS, "updated_at").select("gid")
    new = insert_only_new(rows.where("gid IS NOT NULL"), old, ["gid"], [F.desc("updated_at"), F.desc("date"), F.desc("contents"), F.desc("title")])
    append_days(new.select(*[c.split()[0] for c in NEWS.split(", ")]), published, "updated_at")
