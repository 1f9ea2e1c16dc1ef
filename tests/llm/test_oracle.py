import os

import duckdb
import pytest

from tamarack.llm import registry

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in os.listdir(SF):
        con.execute(f"CREATE VIEW {n.split('.')[0]} AS SELECT * FROM '{SF}/{n}'")
    return con


@pytest.mark.parametrize("name", ["op5_suffix_dedup", "op9_warc", "op10_decontamination"])
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cur = duck.execute(registry.ORACLE_SQL[name])
    assert [x[0] for x in cur.description] == df.columns
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(cur.fetchall(), key=repr)
