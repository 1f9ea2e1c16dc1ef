"""Type repair, validation and standard forms as column expressions. Dirty values give null or the stated default."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes of the rating systems and the ages they stand for, in the order in which systems are asked.
AGE_RATINGS = {
    "esrb": {"e": "3+", "e10+": "10+", "t": "13+", "m": "17+", "ao": "18+", "rp": None},
    "pegi": {"3": "3+", "7": "7+", "12": "12+", "16": "16+", "18": "18+"},
    "usk": {"0": "0+", "6": "6+", "12": "12+", "16": "16+", "18": "18+"},
    "cero": {"a": "3+", "b": "12+", "c": "15+", "d": "17+", "z": "18+"},
}
DATE_FORM, MONTH_FORM = "MMM d, yyyy", "d MMMM yyyy"


def age_rating(**systems: Column) -> Column:
    """Age of the first system whose code is known - null if that code stands for none."""
    out = None
    for name, codes in AGE_RATINGS.items():
        if name in systems:
            code = F.lower(systems[name])
            age = F.lit(None).cast("string")
            for k, v in codes.items():
                age = F.when(code == k, F.lit(v)).otherwise(age)
            hit = code.isin(list(codes))
            out = F.when(hit, age) if out is None else out.when(hit, age)
    return F.lit(None).cast("string") if out is None else out


def required_age(value: Column) -> Column:
    """Non-negative whole number as text, else '0'."""
    n = F.trim(value.cast("string")).try_cast("int")
    return F.when(n >= 0, n).otherwise(0).cast("string")


def age_feature(age: Column) -> Column:
    """Age in [0, 1]: null as 0, cut at 100."""
    return F.least(F.greatest(F.coalesce(age.try_cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(100.0)) / 100


def price(value: Column) -> Column:
    """The value if it is a whole number of at least 0, else null."""
    return F.when(F.trim(value.cast("string")).try_cast("bigint") >= 0, value)


def int_array(values: Column) -> Column:
    """The elements that are whole numbers; null gives an empty array."""
    return F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x).try_cast("int")), lambda x: x.isNotNull())


def descriptions(values: Column) -> Column:
    """The descriptions of an array of structs; null gives an empty array."""
    return F.coalesce(F.transform(values, lambda x: x["description"]), F.array().cast("array<string>"))


def total_or_zero(parent: Column, field: str) -> Column:
    """The number at a field of an object in JSON text: 0 where there is no object or it lacks the field, null only where the
    field is null itself."""
    value = F.from_json(parent, "map<string,string>")[field]
    has = F.array_contains(F.json_object_keys(parent), field)
    return F.when(F.coalesce(has, F.lit(False)), value.try_cast("int")).otherwise(0)


def requirements(raw: Column, clean) -> Column:
    """struct(minimum, recommended) from JSON text: an object's fields, text alone as the minimum, a list as neither."""
    parsed = F.from_json(raw, "minimum string, recommended string")
    is_object, is_list = F.ltrim(raw).startswith("{"), F.ltrim(raw).startswith("[")
    least = F.when(is_object, parsed["minimum"]).when(is_list, "").otherwise(raw)
    most = F.when(is_object, parsed["recommended"]).otherwise("")
    return F.struct(clean(least).alias("minimum"), clean(most).alias("recommended"))


def parent_item(item: Column, clean) -> Column:
    """struct(appid, name), null if it has neither."""
    appid, name = item["appid"].cast("string").try_cast("int"), clean(item["name"])
    return F.when(appid.isNotNull() | (F.length(name) > 0), F.struct(appid.alias("appid"), name.alias("name")))


def release_date(text: Column) -> Column:
    """yyyy-MM-dd where it can be read, else the text."""
    return F.coalesce(F.date_format(F.try_to_date(text, DATE_FORM), "yyyy-MM-dd"), text)


def month(text: Column) -> Column:
    """yyyy-MM of "July 2021", null if it isn't one."""
    return F.date_format(F.try_to_date(F.concat(F.lit("1 "), text), MONTH_FORM), "yyyy-MM")


def chart_number(text: Column) -> Column:
    """Number with dots between thousands, a plus or a per cent sign; null if it isn't one."""
    return F.regexp_replace(text, "[.+%]", "").try_cast("double")


def chart_percent(text: Column) -> Column:
    """Per cent with a decimal dot; null if it isn't one."""
    return F.regexp_replace(text, "[+%]", "").try_cast("double")


def epoch_date(seconds: Column) -> Column:
    """Day (UTC) of seconds since 1970, as yyyy-MM-dd."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def price_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def polled_players(count: Column) -> Column:
    """A polled number of players; a poll that failed is -1."""
    return F.coalesce(count, F.lit(-1)).cast("bigint")
