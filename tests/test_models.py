import math
import random

import pytest
from pyspark.ml.linalg import Vectors

from tamarack.operators import features as M
from tamarack.operators import language as G
from tamarack.operators import vectors as X

SF = "/root/testdata/sf0.01"


def brute(items, queries, top=None, threshold=None):
    out = []
    for q, v in queries:
        found = [(round(sum(a * b for a, b in zip(v, w)), 6) + 0.0, k) for k, w in items if k is not None and w is not None and None not in w]
        found = sorted((-s, k) for s, k in found if not math.isnan(s) and (threshold is None or s >= threshold))
        out += [(q, k, -s + 0.0, r + 1) for r, (s, k) in enumerate(found[:top])]
    return sorted(out)


def test_search_equals_brute_force_over_blocks_and_passes(spark, monkeypatch):
    rng = random.Random(3)
    vec = lambda: [rng.randrange(-3, 4) / 2 for _ in range(5)]
    items = [(k, vec()) for k in range(400)] + [(None, vec()), (401, None), (402, [1.0, None, 0.0, 0.0, 0.0]), (403, [float("nan")] * 5)]
    queries = [(k, vec()) for k in range(30)]
    kind = "key long, v array<double>"
    df = spark.createDataFrame(items, kind).repartition(3)
    asked = spark.createDataFrame([*queries, queries[0], (None, vec()), (77, None)], kind)
    for name, size in (("BLOCK_ROWS", 7), ("BLOCK_QUERIES", 4), ("PASS_QUERIES", 9)):
        monkeypatch.setattr(X, name, size)
    got = X.search(df, asked, "v", "key", top=6)
    assert sorted((r["query"], r["key"], r["similarity"], r["rank"]) for r in got.collect()) == brute(items, queries, top=6)
    got = X.search(df, asked, "v", "key", threshold=3.0)
    assert sorted(map(tuple, got.collect())) == [r[:3] for r in brute(items, queries, threshold=3.0)]
    assert not X.search(df.where("false"), asked, "v", "key", top=2).count() and not X.search(df, asked.where("false"), "v", "key", top=2).count()
    names = X.search(df.selectExpr("'k' || key AS key", "v"), asked, "v", "key", top=1)
    assert names.where("query IS NOT NULL").count() == 30 and dict(names.dtypes)["key"] == "string"


def test_search_joins_no_rows(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    plan = X.search(e, e.where("vec_id % 100 = 0"), "embedding", "vec_id", top=10)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan
    with pytest.raises(Exception, match="components"):
        X.search(e, spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>"), "embedding", "vec_id", top=1).collect()


def items(spark):
    rows = [
        (1, "A red fox", None, ["Action", "Indie"], ["Solo"], "16"),
        (2, "a Red, red ring", "fox", ["Indie"], None, None),
        (3, None, None, None, [], "-5"),
        (4, "ünder ß 漢字", "", ["RPG", "Action"], ["Solo", "Online"], "300"),
        (5, "a fox", "ring", [None, "RPG"], ["Online"], "x"),
    ]
    return spark.createDataFrame(rows, "appid int, long_text string, short_text string, genres array<string>, categories array<string>, age string")


def test_features_equal_brute_force(spark):
    df = items(spark)
    model = M.feature_pipeline(df, ["long_text", "short_text"], ["genres", "categories"], "age", buckets=64)
    rows = {r["appid"]: r for r in M.drop_steps(model.transform(df)).collect()}
    assert M.vocabularies(model) == {"genres": ["Action", "Indie", "RPG"], "categories": ["Online", "Solo"]}
    bucket = next(s for s in model.stages if isinstance(s, M.HashingTF)).indexOf
    words = {1: "a red fox", 2: "a red red ring fox", 3: "", 4: "ünder ß 漢字", 5: "a fox ring"}
    hot = {1: [1, 1, 0, 0, 1], 2: [0, 1, 0, 0, 0], 3: [0] * 5, 4: [1, 0, 1, 1, 1], 5: [0, 0, 1, 1, 0]}
    age = {1: 0.16, 2: 0.0, 3: 0.0, 4: 1.0, 5: 0.0}
    seen = {k: {bucket(w) for w in t.split()} for k, t in words.items()}
    for k, t in words.items():
        counts = [0.0] * 64
        for w in t.split():
            counts[bucket(w)] += 1
        assert rows[k]["words"].toArray().tolist() == counts
        weighted = [c * math.log(6 / (sum(b in s for s in seen.values()) + 1)) for b, c in enumerate(counts)]
        raw = [*weighted, *hot[k], age[k]]
        assert rows[k]["features_raw"].toArray().tolist() == pytest.approx(raw)
        size = math.sqrt(sum(x * x for x in raw))
        assert rows[k]["features_unit"].toArray().tolist() == pytest.approx([x / size if size else 0.0 for x in raw])


def test_saved_run_classifies_a_new_item_the_same_in_another_session(spark, tmp_path):
    df = spark.read.parquet(f"{SF}/part.parquet").selectExpr("p_partkey AS appid", "p_name AS name", "split(p_type, ' ') AS genres", "array(p_brand) AS categories", "p_size AS required_age")
    model, scores = M.fit_best(df, M.feature_pipeline(df, ["name"], ["genres", "categories"], "required_age", buckets=32), range(2, 6))
    assert [k for k, _ in scores] == [2, 3, 4, 5] and model.stages[-1].getK() == X.best_k(scores)
    folder = str(tmp_path / "runs")
    M.save_run(model, scores, df, folder, "2024-01-01", "appid", "name")
    other = spark.newSession()
    new = [("steel ring", ["ECONOMY", "Unheard"], ["Brand#2"], 16), (None, None, None, None)]
    kind = "name string, genres array<string>, categories array<string>, required_age int"
    loaded, kept, rows = M.load_run(other, folder)
    a = [(r["cluster"], r["features_raw"]) for r in model.transform(spark.createDataFrame(new, kind)).collect()]
    b = [(r["cluster"], r["features_raw"]) for r in loaded.transform(other.createDataFrame(new, kind)).collect()]
    assert a == b and a[1][1] == Vectors.sparse(len(a[1][1]), {})
    assert [r["k"] for r in kept.where("best").collect()] == [X.best_k(scores)] and rows.count() == df.count()
    M.save_run(model, scores, df, folder, "2024-01-02", "appid", "name")
    assert M.latest_run(spark, folder) == "2024-01-02" and M.load_run(spark, folder, "2024-01-01")[2].count() == df.count()


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(X, "MOST_LABELS", 2)
    with pytest.raises(ValueError, match="labels"):
        M.label_vocabulary(items(spark), "genres")


def test_language_held_out_accuracy(spark):
    """Documents with a label fit the model; of the others of 200 characters or more at least 97 in 100 are found right."""
    docs, known = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").select("doc_id")
    model = G.fit(docs.join(known, "doc_id", "left_semi"), "text", "lang")
    out = G.detect(docs.join(known, "doc_id", "left_anti"), model, "text").where("length(text) >= 200")
    n, right = out.count(), out.where("detected = lang").count()
    assert n > 100 and right >= 0.97 * n


def test_trigrams_and_detection_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(G, "SLICE_CHARS", 5)
    rows = [("x", "AbA  bab"), ("x", None), ("y", "漢字🙂字"), ("y", "ab"), (None, "abc"), ("y", ""), ("x", "aba")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    got = {(r["lang"], "".join(chr(r["code"] >> s & 0x1FFFFF) for s in (42, 21, 0))): r["n"] for r in G.trigram_counts(df, "text", "lang").collect()}
    assert got == {("x", "aba"): 2, ("x", "ba "): 1, ("x", "a b"): 1, ("x", " ba"): 1, ("x", "bab"): 1, ("y", "漢字🙂"): 1, ("y", "字🙂字"): 1}
    model = G.fit(df, "text", "lang")
    found = {r["text"]: r["detected"] for r in G.detect(df, model, "text").collect()}
    assert found == {"AbA  bab": "x", None: None, "漢字🙂字": "y", "ab": None, "abc": None, "": None, "aba": "x"}
    assert not G.detect(df.where("false"), model, "text").count()
    assert {r["detected"] for r in G.detect(df, G.fit(df.where("false"), "text", "lang"), "text").collect()} == {None}
    monkeypatch.setattr(G, "LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        G.fit(df, "text", "lang")
