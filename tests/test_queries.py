import math
import os

import duckdb
import pytest

import __spark_entry__ as e
from tamarack.operators import vectors as X
from tamarack.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in os.listdir(SF):
        con.execute(f"CREATE VIEW {n.split('.')[0]} AS SELECT * FROM '{SF}/{n}'")
    return con


def norm(rows):
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = duck.execute(catalog.ORACLE_SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert norm(tuple(r[c] for c in cols) for r in df.collect()) == norm(tuple(r[i] for i in at) for r in cur.fetchall())


def test_entry(spark):
    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())


def test_clusters(spark):
    out = catalog.cluster_assign(spark, SF)
    assert out.count() == spark.read.parquet(f"{SF}/embeddings.parquet").count() and out.select("cluster").distinct().count() == 5
    rows = catalog.silhouette_sweep(spark, SF).collect()
    best = max(rows, key=lambda r: (r["silhouette_score"], -r["k"]))
    assert [r["k"] for r in rows if r["best"]] == [best["k"]]


def test_no_row_python_in_plans(spark):
    for name in ("winner_per_title", "strip_markup", "upsert_three_step", "similar_items"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "BatchEvalPython" not in plan
    assert "WindowGroupLimit" in catalog.winner_per_title(spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_sweep_covers_the_whole_range(spark):
    assert sorted(r["k"] for r in catalog.silhouette_sweep(spark, SF).collect()) == list(range(X.MIN_K, X.MAX_K + 1)) == list(range(5, 31))
