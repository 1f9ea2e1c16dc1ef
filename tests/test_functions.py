import html
import re

from pyspark.sql import functions as F

from tamarack.functions import text as T
from tamarack.functions import validate as V
from tamarack.plans import landing as L
from tamarack.plans.html_table import rows_of


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def plain_clean(t):
    """Restatement of the cleaning rules with the re module."""
    if not t:
        return ""
    for p in (r"https?://\S+", r"\{STEAM_[A-Z_]+\}/\S*", r"\[\*\]", r"\[/\*\]", r"\[/?[a-zA-Z0-9]+(?:=[^\]]+)?\]", r"<.*?>"):
        t = re.sub(p, "", t)
    t = html.unescape(t)
    t = re.sub(r"[ \t]+", " ", t)
    return re.sub(r"\s*\n\s*", "\n", t).strip()


def test_clean_text(spark):
    cases = [
        None, "", "  a\t b ", "see http://x.y/z now", "[b]x[/b] [url=q]l[/url] [*] [/*] [1] [img src=\"q\"]", "{STEAM_CLAN_IMAGE}/1/2.png end",
        "<p>a</p><br\n>kept", "&amp;lt;b&amp;gt; &lt;i&gt; &eacute; &nope;", "a \n\n\n \xa0 b", "\xa0x　", "x\r\ny", "&nbsp;edge&nbsp;",
    ]
    assert column(spark, cases, T.clean_text) == [plain_clean(c) for c in cases]


def test_names(spark):
    assert column(spark, ["Foo ™", "Foo", " A®  b ", None], T.normalize_title) == ["foo ", "foo", "a b", None]
    assert column(spark, ["Foo ™"], lambda c: T.normalize_title(c, strict=True)) == ["foo"]
    assert column(spark, ["A b: c/™-d_é", None], T.slugify) == ["A_b_c-d_", None]
    assert column(spark, ["Portal DEMO: x", "Été 2", "Odd"], lambda c: T.url_slug_name(c, {"Odd": "even"})) == ["portal--x", "été-2", "even"]
    assert column(spark, ["transcript_abc-1.ndjson", "other.txt"], lambda c: T.id_from_file(c, "transcript_")) == ["abc-1", ""]
    rows = spark.createDataFrame([("a", None, " c "), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in rows.select(T.combine_fields(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["a   c", ""]
    act = spark.createDataFrame([("", "en"), ("short", "en"), ("x" * 60, "en"), ("x" * 60, None), (None, "en")], "t string, l string")
    assert [r[0] for r in act.select(T.translate_action(F.col("t"), F.col("l"))).collect()] == ["empty", "short", "keep_en", "translate", "empty"]


def test_age_rating(spark):
    rows = [("E", None, None, None), ("RP", "16", None, None), ("zz", "16", None, None), (None, None, "0", "Z"), (None, None, "x", "Z"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "esrb string, pegi string, usk string, cero string")
    got = [r[0] for r in df.select(V.age_rating(**{c: F.col(c) for c in df.columns})).collect()]
    assert got == ["3+", None, "16+", "0+", "18+", None]


def test_repairs(spark):
    assert column(spark, ["16+", "-1", " 17 ", None, "16.9", "18"], V.required_age) == ["0", "0", "17", "0", "0", "18"]
    assert column(spark, ["16", None, "500", "-3"], V.age_feature) == [0.16, 0.0, 1.0, 0.0]
    assert column(spark, ["100", "-1", "x", None], V.price) == ["100", None, None, None]
    assert column(spark, [["1", " 2 ", "x", None], None], V.int_array, "array<string>") == [[1, 2], []]
    assert column(spark, ["Oct 5, 2021", "Coming soon", None], V.release_date) == ["2021-10-05", "Coming soon", None]
    assert column(spark, ["July 2021", "Foo 2020", None], V.month) == ["2021-07", None, None]
    assert column(spark, ["1.234", "+12.5%", "-", "+7"], V.chart_number) == [1234.0, 125.0, None, 7.0]
    assert column(spark, ["+12.5%", "-3%", "x"], V.chart_percent) == [12.5, -3.0, None]
    assert column(spark, [0, 86399, 86400, None], V.epoch_date, "bigint") == ["1970-01-01", "1970-01-01", "1970-01-02", None]
    got = column(spark, ['{"minimum":"<b>m</b>","recommended":"r"}', "[]", "plain", None], lambda c: V.requirements(c, T.clean_text))
    assert [tuple(g) for g in got] == [("m", "r"), ("", ""), ("plain", ""), ("", "")]
    items = column(spark, [("7", "n"), (None, "<i>n</i>"), ("x", None), None], lambda c: V.parent_item(c, T.clean_text), "struct<appid:string,name:string>")
    assert [i and tuple(i) for i in items] == [(7, "n"), (None, "n"), None, None]


PAGE = """<table class="other"><tr><td>no</td></tr></table><table class="w-full caption-bottom text-sm"><tr><th>Month</th></tr>
<tr><td>July 2021</td><td>1.234</td><td>+10</td><td>+12.5%</td><td>2.000</td></tr><tr><td>Foo 2020</td><td>1</td><td>1</td><td>1</td><td>1</td></tr>
<tr><td>short</td></tr><tr><td>June 2021</td><td>-</td><td>-5</td><td>-1%</td><td>9</td></tr><tr><td>June 2021</td><td>7</td><td>-5</td><td>-1%</td><td>9</td></tr></table>"""


def test_chart_tables(spark):
    assert len(rows_of(PAGE, "w-full text-sm")) == 6 and rows_of("<p>none</p>", "x") == []
    pages = spark.createDataFrame([(1, PAGE), (2, None)], "appid int, html string")
    cells = pages.select("appid", F.posexplode(L.table_cells(F.col("html"), "w-full caption-bottom text-sm")).alias("position", "cells"))
    got = {r["month"]: tuple(r)[2:] for r in L.monthly_players(cells).collect()}
    assert got == {"2021-07": (1234.0, 10.0, 12.5, 2000.0), "2021-06": (7.0, -5.0, -1.0, 9.0)}
