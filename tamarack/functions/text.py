"""Text cleaning and naming as column expressions. Unicode white space is meant wherever white space is."""

from __future__ import annotations

from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

MIN_LEN_TO_DETECT = 50

#: Display names whose chart pages go by another name. Results depend on them, so they are a parameter.
NAME_OVERRIDES: dict[str, str] = {
    "ULTRATORO 2 Demo": "ultratoro",
    "King of Kinks Wallpaper": "king-of-kinks",
    "忍堕とし": "nin-datoshi",
    "Sailist Demo": "sailist",
    "Naheulbeuk's Dungeon Master Demo": "naheulbeuks-dungeon-master",
    "Twist & Turn": "twist-and-turn",
    "ONE PIECE: PIRATE WARRIORS 4 Character Pass 2": "one-piece-pirate-warriors-4",
    "Dead City: Sci-Fi Pack": "dead-city",
    "Pine Hearts Demo": "pine-hearts",
    "Tenders fight Demo": "tenders-fight",
    "Probo Rush Demo": "probo-rush",
}


def strip_markup(text: Column) -> Column:
    """Without addresses, placeholders like {STEAM_X}/..., BBCode and tags; entities stay. Null gives null."""
    for pattern in (r"(?U)https?://\S+", r"(?U)\{STEAM_[A-Z_]+\}/\S*", r"\[\*\]", r"\[/\*\]", r"\[/?[a-zA-Z0-9]+(?:=[^\]]+)?\]", r"(?d)<.*?>"):
        text = F.regexp_replace(text, pattern, "")
    return text


def squeeze(text: Column) -> Column:
    """One blank between words, one line end between lines, none at the ends."""
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, r"(?U)\s*\n\s*", "\n")
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


@F.arrow_udf(StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return pa.array([None if (t := x.as_py()) is None else unescape(t) if "&" in t else t for x in texts], pa.string())


def clean_text(text: Column) -> Column:
    """Markup stripped, then entities resolved, then white space squeezed; null gives ''. Escaped tags survive one pass."""
    return squeeze(_unescape(strip_markup(F.coalesce(text, F.lit("")))))


def translate_action(cleaned: Column, lang: Column) -> Column:
    """What a translator has to do: empty, short (always translated), keep_en or translate."""
    return (
        F.when(F.coalesce(F.length(cleaned), F.lit(0)) == 0, "empty")
        .when(F.length(cleaned) < MIN_LEN_TO_DETECT, "short")
        .when(lang.eqNullSafe(F.lit("en")), "keep_en")
        .otherwise("translate")
    )


def normalize_title(name: Column, strict: bool = False) -> Column:
    """Key under which titles count as the same. strict trims after the marks are gone, so that "Foo ™" equals "Foo"."""
    out = F.lower(F.regexp_replace(F.regexp_replace(F.trim(name), "[™®]", ""), r"\s+", " "))
    return F.trim(out) if strict else out


def slugify(name: Column) -> Column:
    return F.regexp_replace(F.replace(name, F.lit(" "), F.lit("_")), "[^0-9A-Za-z_-]", "")


def url_slug_name(name: Column, overrides: dict[str, str] | None = None) -> Column:
    """Name as chart addresses have it: overrides, no word DEMO, only word characters, blanks to hyphens."""
    given = NAME_OVERRIDES if overrides is None else overrides
    out = F.regexp_replace(name, r"(?iU)\bDEMO\b", "")
    out = F.regexp_replace(out, r"(?U)^\s+|\s+$", "")
    out = F.regexp_replace(out, r"(?U)[^\w\s-]", "")
    out = F.replace(F.lower(F.regexp_replace(out, r"(?U)^\s+|\s+$", "")), F.lit(" "), F.lit("-"))
    if given:
        at = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])
        out = F.coalesce(F.try_element_at(at, name), out)
    return out


def combine_fields(*fields: Column) -> Column:
    """The fields with a blank between, null as '', ends trimmed."""
    parts = [F.coalesce(f, F.lit("")) for f in fields]
    spaced = [x for p in parts for x in (F.lit(" "), p)][1:]
    return F.trim(F.concat(*spaced))


def id_from_file(path: Column, prefix: str, suffix: str = ".ndjson") -> Column:
    """What a file's name has between prefix and suffix."""
    return F.regexp_extract(path, rf"{prefix}([^/]*)\Q{suffix}\E$", 1)


def is_expansion_page(title: Column, html: Column) -> Column:
    """Page of an add-on: DLC in the title or Expansion in the page."""
    return F.contains(F.coalesce(title, F.lit("")), F.lit("DLC")) | F.contains(F.coalesce(html, F.lit("")), F.lit("Expansion"))
