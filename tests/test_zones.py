import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tamarack.operators import keyed as K
from tamarack.operators import publish as P
from tamarack.operators import vectors as X
from tamarack.plans import landing as L
from tamarack.sources import readers as R
from tamarack.sources import sinks as S
from tamarack.streaming import incremental as I

DAY = date(2024, 5, 1)


def game(appid, name, kind="game", **more):
    return {"appid": appid, "details": json.dumps({"type": kind, "name": name} | more)}


@pytest.fixture
def landing(tmp_path):
    rows = [
        game(1, "<b>Foo</b>", required_age=17, recommendations={"total": 5}, genres=[{"description": "Action"}], dlc=["10", "x"], pc_requirements=[], release_date={"date": "Oct 5, 2021"}, ratings={"esrb": {"rating": "RP"}}),
        game(2, " foo ", recommendations={"total": 9}, price_overview={"final": -4, "currency": "USD"}, mac_requirements={"minimum": "8 GB"}),
        game(3, "Bar ®", required_age="16+", platforms={"windows": True}),
        game(10, "Foo DLC", "dlc", fullgame={"appid": "1", "name": "Foo"}),
        game(11, "Foo DLC 2", "dlc", fullgame={"appid": "1"}),
        game(12, "Lost DLC", "dlc", fullgame={"appid": "2"}),
        game(20, "Aged", "<i>demo</i>", age_ratings={"esrb": {"rating": "M"}}, controller_support="<b>full</b>", recommendations={}),
        game(21, "Older", "demo", ratings={"esrb": {"rating": "zz"}, "pegi": {"rating": "12"}}, recommendations={"total": None}),
        game(22, "Code", "demo", age_ratings={"usk": "6"}),
        {"appid": 4, "details": None},
    ]
    (tmp_path / "games_2024_05_01.ndjson").write_text("\n".join(map(json.dumps, rows)))
    return str(tmp_path)


def test_games_from_landing_to_published(spark, landing):
    raw = R.dated_ndjson(spark, landing, R.GAMES, "games", DAY)
    trusted = L.games(raw, DAY)
    assert len(trusted.columns) == 27
    by = {r["appid"]: r for r in trusted.collect()}
    assert by[1]["name"] == "Foo" and by[1]["dlc"] == [10] and by[1]["release_date"] == "2021-10-05" and by[1]["age_rating"] is None and by[1]["genres"] == ["Action"]
    assert by[2]["price_overview"]["final"] is None and by[2]["mac_requirements"]["minimum"] == "8 GB" and by[3]["required_age"] == "0"
    assert by[4]["name"] == "" and by[4]["type"] == "" and by[4]["is_free"] is False and by[4]["developers"] == [] and by[4]["recommendations_total"] == 0 and by[10]["fullgame"]["appid"] == 1
    assert (by[20]["age_rating"], by[20]["type"], by[20]["controller_support"], by[20]["recommendations_total"]) == ("17+", "demo", "full", 0)
    assert by[21]["age_rating"] == "12+" and by[22]["age_rating"] == "6+" and by[21]["recommendations_total"] is None and by[1]["recommendations_total"] == 5
    out = {r["appid"]: r for r in P.full_refresh(trusted).collect()}
    assert set(out) == {1, 3} and [d["appid"] for d in out[1]["dlc"]] == [10, 11] and out[3]["dlc"] == []
    games, children = P.incremental(trusted, DAY)
    assert {r["appid"] for r in games.collect()} == {1, 2, 3} and {(r["base_appid"], r["dlc_doc"]["appid"]) for r in children.collect()} == {(1, 10), (1, 11), (2, 12)}
    assert P.incremental(trusted, date(2024, 5, 2))[0].isEmpty()


def test_readers(spark, tmp_path):
    for n, rows in ((2, [{"appid": 1, "name": "late"}, {"appid": 3, "name": " c "}]), (10, [{"appid": 4, "name": ""}]), (1, [{"appid": 1, "name": "first"}])):
        (tmp_path / f"part{n}.json").write_text(json.dumps(rows))
    (tmp_path / "partx.json").write_text("[]")
    parts = R.numbered_parts(spark, str(tmp_path), R.PARTS, "part")
    assert {tuple(r) for r in L.all_games(parts).collect()} == {(1, "first"), (3, "c")}
    (tmp_path / "transcript_v1.ndjson").write_text('{"text":"b","start":2.0}\n{"text":"a","start":1.0}\n{"text":null,"start":0.5}')
    (tmp_path / "transcript_v2.ndjson").write_text("")
    got = L.transcripts(R.tagged_ndjson(spark, str(tmp_path), R.TRANSCRIPT, "transcript_", "video_id"))
    assert [tuple(r) for r in got.collect()] == [("v1", "a b")]
    (tmp_path / "reviews_570.ndjson").write_text('{"recommendationid":"1","review":"ok","timestamp_created":5,"timestamp_updated":6}')
    assert [(r["appid"], r["review_clean"]) for r in L.reviews(R.reviews_by_game(spark, str(tmp_path))).collect()] == [(570, "ok")]
    assert R.ndjson(spark, str(tmp_path / "none"), R.NEWS).isEmpty() and R.json_array(spark, str(tmp_path / "none.json"), R.PARTS).isEmpty()
    assert R.json_array(spark, str(tmp_path / "part2.json"), R.PARTS).count() == 2


def test_comments_news_reviews(spark):
    inner = lambda like, at: {"videoId": "v", "authorDisplayName": "a", "textDisplay": "<b>hi</b>", "likeCount": like, "publishedAt": at}
    rows = [{"id": i, "snippet": {"videoId": "v", "topLevelComment": {"snippet": s}}} for i, s in (("1", inner(None, None)), ("2", inner(3, "2024-01-02T00:00:00Z")), ("2", inner(3, "2024-01-02T00:00:00Z")))]
    got = sorted((r["text_clean"], r["publishedAt"], r["likeCount"]) for r in L.comments(spark.createDataFrame(rows, R.COMMENTS)).collect())
    assert got == [("hi", "", 0), ("hi", "2024-01-02", 3)]
    news = spark.createDataFrame([("1", "t", "old", 0, 5), ("1", "t", "new", 86400, 5), ("2", None, None, None, None)], R.NEWS)
    assert {(r["gid"], r["contents"], r["date"]) for r in L.news(news, DAY).collect()} == {("1", "new", "1970-01-02"), ("2", "", None)}
    reviews = spark.createDataFrame([("1", "ok", 5, 6), ("1", "ok", 5, 9), ("2", "<i></i>", 1, 1)], R.REVIEWS)
    assert [(r["recommendationid"], r["timestamp_updated"]) for r in L.reviews(reviews).collect()] == [("1", 9)]


def test_append_new_twice_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, x string")
    assert S.append_new(rows, path, ["id"], [F.asc("x")]) == 2 and S.append_new(rows, path, ["id"], [F.asc("x")]) == 0
    assert S.append_new(spark.createDataFrame([(3, "d")], "id int, x string"), path, ["id"]) == 1
    S.replace(K.upsert(spark.read.parquet(path), spark.createDataFrame([(1, "z")], "id int, x string"), ["id"]), path, ["id"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "z"), (2, "b"), (3, "d")]
    with pytest.raises(ValueError):
        S.replace(rows, path, ["id"])
    S.run_versioned(rows, str(tmp_path / "v"), "20240501")
    S.run_versioned(rows.limit(1), str(tmp_path / "v"), "20240502")
    assert S.read_latest(spark, str(tmp_path / "v")).count() == 1 and spark.read.parquet(str(tmp_path / "v" / "run=20240501")).count() == 3
    assert [r[0] for r in S.as_json(rows.where("x = 'b'").withColumn("n", F.lit(None).cast("int"))).collect()] == ['{"id":2,"x":"b","n":null}']


def test_upsert_three_step(spark):
    old = spark.createDataFrame([(1, "a", "game", "k1"), (2, "b", "game", "k2"), (3, "c", "game", "k3")], "appid int, name string, type string, dlc string")
    new = spark.createDataFrame([(1, "a2", "game", "x"), (20, "b", "game", "x"), (21, "b", "game", "x"), (9, "n", "game", "x")], "appid int, name string, type string, dlc string")
    out, conflicts = K.upsert_three_step(old, new, "appid", ["name", "type"], ["dlc"])
    assert sorted(map(tuple, out.collect())) == [(1, "a2", "game", "k1"), (3, "c", "game", "k3"), (9, "n", "game", None), (21, "b", "game", "k2")]
    assert [r["appid"] for r in conflicts.collect()] == [20]


def test_children(spark):
    old = spark.createDataFrame([(1, ["a"]), (2, None)], "id int, x array<string>")
    new = spark.createDataFrame([(1, "a"), (1, "b"), (5, "q")], "id int, x string")
    assert sorted((r["id"], r["x"]) for r in K.add_to_set(old, new, "id", "x").collect()) == [(1, ["a", "b"]), (2, [])]
    merged = K.set_field(spark.createDataFrame([(1, "n", "t0"), (2, "m", None)], "id int, name string, t string"), spark.createDataFrame([(1, "t1"), (7, "t7")], "id int, t string"), "id", "t")
    assert sorted(map(tuple, merged.collect())) == [(1, "n", "t1"), (2, "m", None), (7, None, "t7")]


def test_vectors(spark):
    assert X.best_k([(5, 0.3), (6, 0.4), (7, 0.4)]) == 6
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [4.0, 3.0])], "id int, v array<double>").withColumn("u", X.l2_normalize(F.col("v")))
    assert {r["id"]: [round(x, 6) for x in r["u"]] for r in rows.collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: [0.8, 0.6]}
    assert [(r["id"], round(r["similarity"], 2)) for r in X.similar(rows, rows.where("id = 1"), "u", "id", 0.9).collect()] == [(1, 1.0), (3, 0.96)]
    labels = spark.createDataFrame([(["b", "a"],), (None,), (["zz"],)], "x array<string>")
    assert [r["label"] for r in X.vocabulary(labels, "x").orderBy("position").collect()] == ["a", "b", "zz"]
    assert [r[0] for r in labels.select(X.multi_hot(F.col("x"), ["a", "b"])).collect()] == [[1, 1], [0, 0], [0, 0]]


def test_streaming_load(spark, tmp_path):
    folder, path, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    folder.mkdir()
    clean = lambda rows: L.news(rows, DAY)
    for n, gids in ((1, ["1", "2"]), (2, ["2", "3"])):
        (folder / f"news_{n}.ndjson").write_text("\n".join(json.dumps({"gid": g, "title": "t", "contents": "c", "date": 1, "appid": 1}) for g in gids))
        I.load_new(I.available_files(spark, str(folder), R.NEWS), clean, path, ["gid"], mark)
    assert sorted(r["gid"] for r in spark.read.parquet(path).collect()) == ["1", "2", "3"]


def test_one_day_is_one_file_and_errors_are_raised(spark, tmp_path):
    for name in ("search_2024_01_01", "search_2024_01_01b"):
        (tmp_path / f"{name}.ndjson").write_text('{"appid": 1}\n')
    assert R.dated_ndjson(spark, str(tmp_path), "appid int", "search", date(2024, 1, 1)).count() == 1
    assert R.ndjson(spark, str(tmp_path / "none"), "appid int").isEmpty()
    with pytest.raises(Exception):
        R.ndjson(spark, str(tmp_path), "appid nonsense")


def test_missing_columns_keep_their_types(spark):
    out = P.conform(spark.createDataFrame([(1,)], "appid int"), P.COLUMNS)
    assert out.columns == P.COLUMNS and out.schema["developers"].dataType.simpleString() == "array<string>" and out.schema["is_free"].dataType.simpleString() == "boolean"
