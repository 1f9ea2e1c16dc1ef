import json
import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tamarack.operators import keyed as K
from tamarack.operators import publish as P
from tamarack.operators import translate as Z
from tamarack.plans import landing as L
from tamarack.sources import manifest as W
from tamarack.sources import metrics as R
from tamarack.sources import sinks as S
from tamarack.sources.parameters import Parameters, read_parameters, selected
from tamarack.streaming import incremental as I

# --- upserts ----------------------------------------------------------------------------------------------------------


def brute_upsert(old, new):
    """The three steps on rows (key, name, type, value), value deciding between equals, then the key."""
    best = lambda rows: max(rows, key=lambda r: (r[3], r[0]))
    keys = {r[0]: r for r in old}
    rows = [best([r for r in new if r[0] == k]) for k in sorted({r[0] for r in new if r[0] is not None})]
    pair = lambda r: None if None in r[1:3] else r[1:3]
    other = lambda r: min([o[0] for o in old if pair(o) and pair(o) == pair(r)], default=None)
    rows = [(r, r[0], 1) if r[0] in keys else (r, other(r), 2) if other(r) is not None else (r, None, 3) for r in rows]
    rows = [x for x in rows if x[1] is None or x == min((y for y in rows if y[1] == x[1]), key=lambda y: (y[2], -y[0][3], -y[0][0]))]
    while True:
        every = [(o, None, 0) for o in old if o[0] not in {x[1] for x in rows}] + rows
        lost = [x for x in rows if pair(x[0]) and any(pair(y[0]) == pair(x[0]) and (y[2], -y[0][3], -y[0][0]) < (x[2], -x[0][3], -x[0][0]) for y in every)]
        if not lost:
            return sorted((x[0] for x in every), key=repr), len(new) - len(rows)
        rows = [x for x in rows if x not in lost]


def test_upsert_equals_brute_force_and_keeps_keys_and_pairs_unique(spark):
    kind = "k int, n string, t string, v int"
    for seed in range(2):
        rng = random.Random(seed)
        row = lambda v, top: (rng.choice([*range(top), None]), rng.choice(["a", "b", "c", "d", None]), rng.choice("gd"), v)
        old, seen = [], set()
        for v in range(30):
            r = row(v, 12)
            if r[0] is not None and r[0] not in {o[0] for o in old} and (None in r or r[1:3] not in seen):
                old.append(r)
                seen.add(r[1:3])
        new = [row(100 + v, 20) for v in range(25)]
        table, conflicts = K.upsert_three_step(spark.createDataFrame(old, kind), spark.createDataFrame(new, kind), "k", ["n", "t"], order=[F.desc("v"), F.desc("k")])
        want, refused = brute_upsert(old, new)
        assert sorted(map(tuple, table.collect()), key=repr) == want and conflicts.count() == refused
        K.assert_unique(table, ["k"])
        K.assert_unique(table, ["n", "t"])
    same = K.upsert_three_step(spark.createDataFrame(old, kind), spark.createDataFrame([], kind), "k", ["n", "t"])[0]
    assert sorted(map(tuple, same.collect()), key=repr) == sorted(old, key=repr)


# --- publishing -------------------------------------------------------------------------------------------------------

KIND = "appid int, type string, name string, dlc array<int>, recommendations_total int, fullgame struct<appid:int,name:string>, updated_at string"


def history(seed, n=120):
    """Records over days: games that change their title, children that change their game or come before it, titles that many share."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        day = f"2024-01-0{rng.randrange(1, 8)}"
        if rng.random() < 0.5:
            rows.append((rng.randrange(12), "game", rng.choice(["Foo", " foo", "Bar™", "bar", "Baz", None, ""]), [1] if rng.random() < 0.3 else None, rng.randrange(3), None, day))
        else:
            rows.append((100 + rng.randrange(25), "dlc", f"d{rng.randrange(3)}", None, None, (rng.choice([*range(12), None]), None), day))
    return rows


@pytest.mark.parametrize("repoint", [False, True])
def test_titles_brought_forward_equal_a_rebuild_after_each_day(spark, repoint):
    trusted = spark.createDataFrame(history(1 + repoint), KIND).coalesce(2)
    table, since = P.rebuild(trusted, "2024-01-01", repoint), "2024-01-01"
    for day in ("2024-01-03", "2024-01-04", "2024-01-07"):
        table, since = P.settled(P.refresh_titles(table, trusted, since, day, repoint), "t"), day
        want = P.rebuild(trusted, day, repoint)
        assert tuple(P.differences(want, table).first())[2:] == (0, 0)
    assert want.count() and K.assert_unique(want, ["appid"]) is None and K.assert_unique(want, ["name", "type"]) is None


def test_children_of_losing_duplicates(spark):
    rows = [(1, "game", "Foo", None, 9, None, "d"), (2, "game", "foo", None, 1, None, "d"), (10, "dlc", "x", None, None, (1, None), "d"), (11, "dlc", "y", None, None, (2, None), "d"), (12, "dlc", "z", None, None, (1, None), "d")]
    ids = lambda df: {r["appid"]: [c["appid"] for c in r["dlc"]] for r in df.collect()}
    trusted = spark.createDataFrame(rows, KIND)
    assert ids(P.full_refresh(trusted)) == {1: [10, 12]} and ids(P.full_refresh(trusted, repoint=True)) == {1: [10, 11, 12]}


def test_incremental_day_replaces_or_adds_children(spark):
    base = P.full_refresh(spark.createDataFrame([(1, "game", "Foo", None, 9, None, "2024-01-01"), (10, "dlc", "x", None, None, (1, None), "2024-01-01")], KIND))
    day = spark.createDataFrame([(1, "game", "Foo 2", None, 7, None, "2024-01-02"), (3, "game", "New", None, 0, None, "2024-01-02"), (10, "dlc", "x2", None, None, (1, None), "2024-01-02"), (13, "dlc", "lost", None, None, (77, None), "2024-01-02")], KIND)
    for union, names in ((False, ["x2"]), (True, ["x", "x2"])):
        table, conflicts = P.apply_incremental(base, day, date(2024, 1, 2), union)
        got = {r["appid"]: (r["name"], [c["name"] for c in r["dlc"]]) for r in table.collect()}
        assert got == {1: ("Foo 2", names), 3: ("New", [])} and conflicts.isEmpty()
        again = P.apply_incremental(table, day, date(2024, 1, 2), union)[0]
        assert tuple(P.differences(table, again).first())[2:] == (0, 0)


def news(*rows):
    return [(g, "t", c, d, 1, u) for g, c, d, u in rows]


def test_news_by_day(spark, tmp_path):
    trusted, published = str(tmp_path / "trusted"), str(tmp_path / "published")
    write = lambda rows: S.write_days(spark.createDataFrame(news(*rows), P.NEWS), trusted, "updated_at")
    read = lambda: sorted((r["gid"], r["contents"]) for r in S.read_days(spark, published, P.NEWS, "updated_at").collect())
    write([("1", "a", "d1", "2024-01-01"), ("1", "b", "d2", "2024-01-01"), ("2", "c", "d1", "2024-01-02"), (None, "x", "d", "2024-01-02")])
    P.publish_news(spark, trusted, published, date(2024, 1, 2))
    assert read() == [("1", "b"), ("2", "c")]
    write([("2", "new", "d", "2024-01-03"), ("3", "d", "d", "2024-01-03"), ("4", "late", "d", "2024-01-04")])
    for _ in range(2):  # the second run adds nothing
        P.publish_news(spark, trusted, published, date(2024, 1, 3))
        assert read() == [("1", "b"), ("2", "c"), ("3", "d")]
    write([("5", "e", "d", "2024-01-03")])  # a day's partition is replaced whole, the others stay
    assert sorted(r["gid"] or "" for r in S.read_days(spark, trusted, P.NEWS, "updated_at").collect()) == ["", "1", "1", "2", "4", "5"]
    plan = S.read_days(spark, trusted, P.NEWS, "updated_at", date(2024, 1, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(updated_at" in plan and "2024-01-03" in plan
    assert S.read_days(spark, str(tmp_path / "none"), P.NEWS, "updated_at").isEmpty()


# --- landing ----------------------------------------------------------------------------------------------------------


def test_answers_that_failed_are_asked_for_again(spark):
    body = lambda k, x: json.dumps({k: x})
    rows = [(1, body("1", {"success": True, "data": {"name": "a"}})), (2, body("2", {"success": False})), (3, "<html>"), (4, None), (5, body("6", {"success": True, "data": {}})), (3, None)]
    landed = L.unwrap(spark.createDataFrame(rows, "appid int, body string"), "appid", "body")
    assert sorted(map(tuple, landed.distinct().collect())) == [(1, '{"name":"a"}', False), (2, None, False), (3, None, True), (4, None, True), (5, None, True)]
    wanted = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, 9, 9)], "appid int")
    assert sorted(r[0] for r in L.to_fetch(wanted, landed, "appid").collect()) == [3, 4, 5, 9]


def test_reading_ends_at_the_mark(spark):
    page = lambda k, n, *at: (k, n, [(f"{k}{t}", t) for t in at])
    pages = spark.createDataFrame([page("a", 0, 9, 8), page("a", 1, 7, 5), page("a", 2, 6, 4), page("b", 0, 3, 2), page("b", 1, 1), ("c", 0, []), page("c", 1, 2)], "k string, p int, items array<struct<id:string,at:int>>")
    marks = spark.createDataFrame([("a", 5), ("c", 0)], "k string, mark int")
    got = sorted((r["id"], r["p"]) for r in L.until_mark(pages, marks, "k", "p", "items", "at").collect())
    # a6 stands behind the page with the mark and isn't read
    assert got == [("a7", 1), ("a8", 0), ("a9", 0), ("b1", 1), ("b2", 0), ("b3", 0), ("c2", 1)]


# --- tables -----------------------------------------------------------------------------------------------------------


def test_versions(spark, tmp_path):
    path, rows = str(tmp_path / "t"), lambda *x: spark.createDataFrame([(i, f"n{i}") for i in x], "k int, n string")
    with pytest.raises(FileNotFoundError):
        S.read_version(spark, path)
    assert [S.write_version(rows(*range(n)), path, [["k"], ["n"]]) for n in (1, 2, 3)] == [1, 2, 3]
    assert S.versions(spark, path) == [2, 3] and S.read_version(spark, path).count() == 3 and S.read_version(spark, path, 2).count() == 2
    with pytest.raises(ValueError, match="unique"):
        S.write_version(rows(1, 1), path, [["k"]])
    os.makedirs(f"{path}/v=9")  # of a run that broke off: without its mark
    assert S.versions(spark, path) == [2, 3] and S.read_version(spark, path).count() == 3


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(k, None if k % 2 else f"x,{k}") for k in range(25)], "k int, n string").coalesce(1)
    for kind in ("csv", "json", "parquet"):
        S.export(df, str(tmp_path / kind), kind, max_records=10)
        assert len([f for f in os.listdir(tmp_path / kind) if f.startswith("part-")]) == 3
    back = spark.read.schema("k int, n string").option("header", True).csv(str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect())) and '"n":null' in (tmp_path / "json" / sorted(f for f in os.listdir(tmp_path / "json") if f.startswith("part-"))[0]).read_text()
    for n in (10, 25, 25):
        S.resume_ndjson(df.where(F.col("k") < n), str(tmp_path / "resumed"), ["k"])
    assert sorted(r["k"] for r in spark.read.json(str(tmp_path / "resumed")).collect()) == list(range(25))
    with pytest.raises(ValueError):
        S.export(df, str(tmp_path / "x"), "xls")


def test_work_goes_on_after_a_task_that_was_killed(spark, tmp_path):
    out, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    df = spark.createDataFrame([(k, f"t{k}") for k in range(20)] + [(None, "x")], "k int, text string").repartition(4)
    asked = lambda: W.pending(df, manifest, "up", "k", ["text"]).count()
    upper = lambda rows: rows.select("k", F.upper("text").alias("text"), "digest")
    broken = lambda rows: upper(rows).withColumn("text", F.when(F.col("k") == 13, F.raise_error(F.lit("killed"))).otherwise(F.col("text")))
    assert W.process(df.where("k < 5"), upper, out, manifest, "up", "k", ["text"]) == 5
    with pytest.raises(Exception, match="killed"):
        W.process(df, broken, out, manifest, "up", "k", ["text"])
    assert asked() == 15 and W.process(df, upper, out, manifest, "up", "k", ["text"]) == 15 and asked() == 0
    assert W.process(df, upper, out, manifest, "up", "k", ["text"]) == 0
    changed = df.withColumn("text", F.when(F.col("k") == 3, "again").otherwise(F.col("text")))
    assert W.process(changed, upper, out, manifest, "up", "k", ["text"]) == 1
    rows = W.finished(spark, out, manifest, "up", "k", "k int, text string, digest string")
    assert sorted((r["k"], r["text"]) for r in rows.collect()) == [(k, "AGAIN" if k == 3 else f"T{k}") for k in range(20)]
    assert W.pending(df, manifest, "other", "k", ["text"]).count() == 20


def test_run_metrics_need_no_job_of_their_own(spark, tmp_path):
    run, path = R.Run("r1"), str(tmp_path / "runs")
    rows = run.observe(spark.range(100).where("id % 4 = 0"), "load", rows=F.count(F.lit(1)), largest=F.max("id"))
    rows.write.parquet(str(tmp_path / "t"))
    run.put("search", threshold=0.9)
    run.record(spark, path)
    R.Run("r2").record(spark, path)
    got = sorted(map(tuple, R.read_runs(spark, path).collect()))
    assert got == [("r1", "load", "largest", 96.0), ("r1", "load", "rows", 25.0), ("r1", "search", "threshold", 0.9)]
    assert R.read_runs(spark, str(tmp_path / "none")).isEmpty()


# --- streams ----------------------------------------------------------------------------------------------------------


def put(folder, name, rows):
    (folder / f"{name}.ndjson").write_text("\n".join(json.dumps({"k": k, "ts": t, "v": v}) for k, t, v in rows))


def at(minute):
    return f"2024-01-01T00:{minute:02d}:00" if minute is not None else None


def test_streams_go_on_after_restarts(spark, tmp_path):
    """Three runs of each query over one checkpoint: what an earlier run has seen counts."""
    folder = tmp_path / "in"
    folder.mkdir()
    runs = [
        [("a", at(5), 1), ("a", at(9), 2), ("b", at(1), 3), ("a", at(5), 4), (None, at(3), 5), ("a", None, 6)],
        [("a", at(8), 7), ("a", at(10), 8), ("b", at(1), 9), ("c", at(2), 10), (None, at(3), 11), ("e", at(13), 17)],
        [("a", at(10), 12), ("b", at(20), 13), (None, at(4), 14), ("a", at(11), 15), ("d", at(0), 16)],
    ]
    kinds = {"marks": lambda s: I.above_marks(s, "k", "ts"), "exact": lambda s: I.dedup_exact(s, ["k"]).select("k"), "recent": lambda s: I.dedup_recent(s, ["k"], "ts", "5 minutes").select("k", "ts")}
    for n, rows in enumerate(runs):
        put(folder, f"f{n}", rows)
        for name, step in kinds.items():
            stream = I.available_files(spark, str(folder), "k string, ts timestamp, v int")
            I.run_available(step(stream), str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"))
    read = lambda name: spark.read.parquet(str(tmp_path / name)).collect()
    assert sorted(r["v"] for r in read("marks")) == [1, 2, 3, 4, 5, 8, 10, 13, 14, 15, 16, 17]
    assert sorted((r["k"] or "") for r in read("exact")) == ["", "a", "b", "c", "d", "e"]
    got = [r["k"] for r in read("recent")]
    # c and d come too late; b again after its time
    assert [got.count(k) for k in ("b", "c", "d", "e", None)] == [2, 0, 0, 1, 1]


# --- translation and parameters ---------------------------------------------------------------------------------------


def test_each_text_is_translated_once(spark, tmp_path):
    cache, asked = str(tmp_path / "cache"), spark.sparkContext.accumulator(0)
    long = lambda w: " ".join([w] * 30)
    rows = [(1, "hola", "es"), (2, "hola", "es"), (3, long("hi"), "en"), (4, long("ja"), "de"), (5, long("ja"), "de"), (6, None, "de"), (7, "", None), (8, long("no"), None), (9, long("bad"), "fr")]

    def service(batches):
        for b in batches:
            asked.add(len(b))
            b["translated"] = [None if t.startswith("bad") else f"<{t}>" for t in b["text"]]
            yield b[["digest", "translated"]]

    def run(rows):
        df = spark.createDataFrame(rows, "k int, text string, lang string").repartition(3)
        out = Z.translate_stage(df, "text", "lang", cache, lambda x: x.mapInPandas(service, "digest string, translated string"))
        return {r["k"]: (r["action"], r["text"]) for r in [*out.collect(), *out.collect()]}

    want = {1: ("short", "<hola>"), 2: ("short", "<hola>"), 3: ("keep_en", long("hi")), 4: ("translate", f"<{long('ja')}>"), 5: ("translate", f"<{long('ja')}>"), 6: ("empty", ""), 7: ("empty", ""), 8: ("translate", f"<{long('no')}>"), 9: ("translate", long("bad"))}
    assert run(rows) == want and asked.value == 4
    assert run([*rows, (10, "hola", "es")]) == want | {10: ("short", "<hola>")} and asked.value == 5  # the one that failed, again


def test_parameters(spark, tmp_path):
    put = lambda text: (tmp_path / "p").write_text(text) and str(tmp_path / "p")
    assert read_parameters(spark, put("{}")) == Parameters() and list(Parameters().ks) == list(range(5, 31))
    p = read_parameters(spark, put('{"clustering": {"min_k": 3, "n_init": "auto"}, "similitud": {"umbral": 0.5}, "run": {"mode": "FULL"}, "other": 1}'))
    assert (p.min_k, p.max_k, p.umbral, p.mode) == (3, 30, 0.5, "FULL")
    pytest.importorskip("yaml")
    p = read_parameters(spark, put("clustering:\n  min_k: 4\n  max_k: 6\nrun:\n  trial_ids: [7]\n"))
    assert (p.ks, p.trial_ids) == (range(4, 7), (7,))
    df = spark.range(10).withColumnRenamed("id", "appid")
    assert [r[0] for r in selected(df, "appid", p).collect()] == [7] and selected(df, "appid", Parameters(mode="FULL")).count() == 10
    for bad in ('{"clustering": {"min_k": 1}}', '{"similitud": {"umbral": 2}}', '{"run": {"mode": "x"}}'):
        with pytest.raises(ValueError):
            read_parameters(spark, put(bad))


def test_videos_and_polls(spark):
    hit = lambda k, v, t, at: (k, ("youtube#video", v), (t, None, at, "c"))
    rows = [hit(1, "a", "x", "2024-01-02"), hit(1, "a", "x", "2024-01-02"), hit(1, "b", "y", "2024-01-03"), hit(1, None, "channel", "2024-01-09"), hit(1, "", "z", "2024-01-09"), hit(2, "c", "n", None), (3, None, None)]
    got = L.videos(spark.createDataFrame(rows, "appid int, id struct<kind:string,videoId:string>, snippet struct<title:string,description:string,publishedAt:string,channelTitle:string>"), "appid", 1)
    assert sorted((r["appid"], r["videoId"]) for r in got.collect()) == [(1, "b"), (2, "c")]
    polls = spark.createDataFrame([(1, "2024-01-01 10:00:00", 5), (1, "2024-01-01 10:00:00", None), (1, "2024-01-01 11:00:00", None)], "appid int, at string, n int").withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert sorted((str(r["polled_at"])[11:13], r["day"], r["players"]) for r in L.polls(polls, "appid", "at", "n").collect()) == [("10", "2024-01-01", 5), ("11", "2024-01-01", -1)]


def test_last_versions_move_no_json(spark):
    rows = spark.createDataFrame([("game", 1, "2024-01-01", "a", {"k": 1}), ("game", 1, "2024-01-02", "b", {"k": 2}), ("game", 1, "2024-01-02", "c", None), ("dlc", 1, "2024-01-01", None, None)], "type string, appid int, updated_at string, name string, m map<string,int>")
    assert "to_json" not in P.current(rows.drop("m"))._jdf.queryExecution().toString()
    for df in (rows, rows.drop("m")):
        assert sorted((r["type"], r["appid"], r["name"]) for r in P.current(df).collect()) == [("dlc", 1, None), ("game", 1, "c")]


def test_differences_count_repeated_rows(spark):
    left, right = (spark.createDataFrame([(x, [y]) for x, y in v], "a int, b array<string>") for v in ([(1, "x"), (1, "x"), (2, None)], [(1, "x"), (3, "y")]))
    assert tuple(P.differences(left, right).first()) == (3, 2, 2, 1)
    assert tuple(P.differences(left.limit(0), right.limit(0)).first()) == (0, 0, 0, 0)
