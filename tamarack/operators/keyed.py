"""Keys: deterministic dedup, insert-only-new, upserts and unions of children, as DataFrame functions."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settled


def keep_first(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key in this order. A total order makes them the same in every run."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") <= n).drop("__rn")


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return keep_first(df, keys, order, 1)


def any_order(columns: list[str]) -> list[Column]:
    """A total order of rows that differ in these columns, whatever their types."""
    return [F.desc(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))]


def latest(df: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """keys, the latest time and the values that stand there (of several the largest): one aggregate, no sort of the rows."""
    at = F.max(F.struct(time, *values)).alias("__at")
    return df.groupBy(*keys).agg(at).select(*keys, *[F.col(f"__at.{c}").alias(c) for c in (time, *values)])


def distinct_texts(df: DataFrame, text: str, key: str) -> DataFrame:
    """Each distinct text by its digest, with its smallest key and its number of copies; no text is shuffled."""
    return df.groupBy(F.md5(text).alias("text_md5")).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))


def of_day(time: Column, day: date) -> Column:
    """Whether a time falls on this day, as a range that a scan can prune by."""
    lit = lambda d: F.lit(d.isoformat()).cast("timestamp_ntz")
    return (time >= lit(day)) & (time < lit(day + timedelta(days=1)))


def above_mark(df: DataFrame, seen: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Rows of df that are later than the latest of their key in seen; keys that seen lacks have no mark and no rows."""
    mark = seen.groupBy(*keys).agg(F.max(time).alias("__mark"))
    return df.join(mark, keys).where(F.col(time) > F.col("__mark")).drop("__mark")


def limit_by_history(df: DataFrame, history: DataFrame, key: str, known: int, unknown: int, name: str) -> DataFrame:
    """key and how many items to ask for: fewer where the key has a history."""
    seen = keys_of(history, [key]).withColumn("__has", F.lit(True))
    return df.select(key).join(seen, key, "left").select(key, F.when(F.col("__has"), known).otherwise(unknown).cast("long").alias(name))


def usable(column: str, *kinds: object) -> Column:
    """Neither null nor empty, and of these values if any are given."""
    has = F.col(column).isNotNull() & (F.col(column) != "")
    return has & F.col(column).isin(*kinds) if kinds else has


def count_children(parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str, distinct: str | None = None) -> DataFrame:
    """parents with the number of their children (of distinct values, if named), 0 where there are none."""
    n = F.countDistinct(distinct) if distinct else F.count(F.lit(1))
    counts = children.groupBy(F.col(child_key).alias("__k")).agg(n.alias("__n"))
    return parents.join(counts, parents[key] == F.col("__k"), "left").withColumn(name, F.coalesce("__n", F.lit(0).cast("long"))).drop("__k", "__n")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """All rows; every part must have the same columns, in whatever order."""
    return reduce(DataFrame.unionByName, parts)


def keys_of(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def insert_only_new(new: DataFrame, existing: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of new, one per key, whose key isn't among the existing. Both sides stay distributed."""
    one = keep_one(new, keys, order) if order else new.dropDuplicates(keys)
    return one.join(keys_of(existing, keys), keys, "left_anti")


def set_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return keys_of(left, keys).join(keys_of(right, keys), keys, "left_anti")


def attach_if_parent(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    return children.join(keys_of(parents, keys), keys, "left_semi")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """All rows by key, the new ones replacing the old."""
    return old.join(keys_of(new, keys), keys, "left_anti").unionByName(new)


def set_field(old: DataFrame, new: DataFrame, key: str, field: str) -> DataFrame:
    """old with field set from new where the key is there, and new's rows besides (other columns null)."""
    new = new.select(F.col(key).alias("__k"), F.col(field).alias("__v"))
    out = old.join(new, old[key].eqNullSafe(F.col("__k")), "full_outer")
    rest = [c for c in old.columns if c not in (key, field)]
    return out.select(F.coalesce(old[key], F.col("__k")).alias(key), *[old[c] for c in rest], F.when(F.col("__k").isNotNull(), F.col("__v")).otherwise(old[field]).alias(field))


def upsert_three_step(old: DataFrame, new: DataFrame, key: str, alternate: list[str], keep: list[str] | None = None, order: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of new update the old row with their key, else the old row with their alternate key (which takes the new key
    too), else they are inserted. Columns in keep stay as the old row has them, null in inserted rows.

    No key and no alternate key stands twice afterwards, unless it did in old. What gives way is returned beside the table as
    conflicts, with the reason: a row of new without a key ("no key") or whose key another row of new has ("repeated key"), whose old row another one
    updates ("same row": found by key comes first), or whose alternate key is another row's ("alternate taken": unchanged old
    rows come first, then updated by key, updated by alternate, inserted). Of equals the first by order counts (default: the
    larger row as JSON). An update that gives way leaves the old row as it was, whose alternate key may then be taken by a third
    row: the last rule is repeated until nothing more gives way. A null in the alternate key equals nothing."""
    keep = keep or []
    fields = [c for c in old.columns if c not in keep]
    order = order or any_order(fields)
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("__how", *order))
    refuse = lambda rows, reason: rows.select(*fields, F.lit(reason).alias("reason"))
    rows = new.where(F.col(key).isNotNull()).select(*fields).withColumn("__how", F.lit(0)).withColumn("__rn", rank(key))
    conflicts = [refuse(new.where(F.col(key).isNull()), "no key"), refuse(rows.where("__rn > 1"), "repeated key")]
    rows = rows.where("__rn = 1").drop("__rn", "__how")
    # what each row updates: the old key by key, else by alternate key (of several the smallest)
    own = old.select(F.col(key).alias("__old"))
    pair = [F.col(c) == F.col(f"__a{i}") for i, c in enumerate(alternate)]
    by_alternate = old.groupBy(*[F.col(c).alias(f"__a{i}") for i, c in enumerate(alternate)]).agg(F.min(key).alias("__other"))
    rows = rows.join(own.distinct(), rows[key] == F.col("__old"), "left").join(by_alternate, pair, "left").drop(*[f"__a{i}" for i in range(len(alternate))])
    rows = rows.withColumn("__how", F.when(F.col("__old").isNotNull(), 1).when(F.col("__other").isNotNull(), 2).otherwise(3)).withColumn("__old", F.coalesce("__old", "__other")).drop("__other")
    # an inserted row has a group of its own, so that they don't all meet
    target = F.when(F.col("__old").isNotNull(), F.concat(F.lit("old "), F.col("__old"))).otherwise(F.concat(F.lit("new "), F.col(key)))
    rows = settled(rows.withColumn("__rn", rank(target)), "upsert")
    conflicts.append(refuse(rows.where("__rn > 1"), "same row"))
    rows = rows.where("__rn = 1").drop("__rn")
    while True:
        changed = old.join(rows.where("__old IS NOT NULL").select(F.col("__old").alias(key)), key, "left_anti").select(*fields).withColumn("__how", F.lit(0))
        every = changed.unionByName(rows.drop("__old")).where(" AND ".join(f"`{c}` IS NOT NULL" for c in alternate))
        lost = settled(every.withColumn("__rn", rank(*alternate)).where("__rn > 1 AND __how > 0").drop("__rn", "__how"), "upsert-lost")
        if lost.isEmpty():
            break
        conflicts.append(refuse(lost, "alternate taken"))
        rows = settled(rows.join(lost.select(key), key, "left_anti"), "upsert")
    won = rows.select(F.col("__old"), *[F.col(c).alias(f"n_{c}") for c in fields])
    updated = old.join(won.where("__old IS NOT NULL"), old[key] == F.col("__old"), "left").select(*[(F.when(F.col("__old").isNotNull(), F.col(f"n_{c}")).otherwise(old[c]) if c in fields else old[c]).alias(c) for c in old.columns])
    inserted = won.where("__old IS NULL").select(*[F.col(f"n_{c}").alias(c) if c in fields else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns])
    return updated.unionByName(inserted), union_all(conflicts)


def add_to_set(old: DataFrame, new: DataFrame, key: str, field: str) -> DataFrame:
    """old (key, array field) with the new elements added that aren't equal to one there; keys that old lacks are dropped."""
    more = new.groupBy(F.col(key).alias("__k")).agg(F.array_sort(F.collect_set(field)).alias("__more"))
    out = old.join(more, old[key] == F.col("__k"), "left")
    return out.withColumn(field, F.array_union(F.coalesce(F.col(field), F.col("__more"), F.array().cast(old.schema[field].dataType)), F.coalesce(F.col("__more"), F.array().cast(old.schema[field].dataType)))).drop("__k", "__more")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """Raises if a key stands twice (one with a null in it is none)."""
    whole = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) if len(keys) > 1 else df
    again = whole.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"key {again[0].asDict()} isn't unique")


def nest(children: DataFrame, parent_key: str, child_key: str, columns: list[str], name: str) -> DataFrame:
    """parent_key and an array of structs, in order of the child key."""
    return children.groupBy(parent_key).agg(F.array_sort(F.collect_list(F.struct(child_key, *[c for c in columns if c != child_key]))).alias(name))


def attach_nested(parents: DataFrame, nested: DataFrame, key: str, name: str) -> DataFrame:
    """parents with the array, an empty one where there are no children."""
    return parents.join(nested, key, "left").withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))
