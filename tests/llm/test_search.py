import math
import random
import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarack.llm import search as S

from .conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, top=10):
    """Every query against every document, by the formula."""
    tf = [(i, Counter(cut(t))) for i, t in docs]
    tf = [(i, c, sum(c.values())) for i, c in tf if c]
    df = Counter(t for _, c, _ in tf for t in c)
    n_docs, total = len(tf), sum(n for *_, n in tf)
    out = []
    for item, text in items:
        asked = cut(text)
        scored = []
        for doc, c, n in tf:
            m = 25 + 75 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if s > 0:
                scored.append((-s, doc is not None, doc, s))
        out += [(item, k + 1, doc, s) for k, (_, _, doc, s) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("folder", [SF, SF.replace("0.001", "0.01")])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    for n in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{folder}/{n}.parquet'")
    cur = con.execute(S.SQL)
    got = S.op12_lexical_search(spark, folder)
    assert [x[0] for x in cur.description] == got.columns
    assert rows(got) == sorted(cur.fetchall(), key=repr)


def test_ties_repeats_and_small_windows(spark, monkeypatch):
    rng = random.Random(5)
    words = ["a", "B", "c1", "É", "漢字", "d_e", "f"]
    docs = [(i // 2, " ".join(rng.choices(words, k=rng.randrange(0, 9)))) for i in range(300)] + [(7, "a b"), (7, "a b"), (None, "a b"), (None, "a b"), (400, None), (401, ""), (402, " .. ")]
    items = [(1, "A b a"), (1, "A b a"), (2, "c1 É"), (3, "nowhere"), (4, None), (5, ""), (None, "d e f"), (6, "漢字, 漢字")]
    want = plain(docs, items)
    assert rows(S.search(*tables(spark, docs, items))) == want
    assert rows(S.search(*tables(spark, docs, items), block_chars=6)) == want  # several blocks of queries


def test_windows_cover_every_row_once():
    import pyarrow as pa

    lists = [[1] * k for k in (0, 3, 9, 1, 1, 0, 4, 12, 2)]
    b = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(range(9)), pa.array(lists)], ["id", "n", "terms"])
    for most in (1, 4, 5, 100):
        parts = list(S.windows(iter([b, b.slice(0, 0), b.slice(3, 4)]), most))
        assert [i for p in parts for i in p.column(0).to_pylist()] == [*range(9), *range(3, 7)]
        assert all(p.num_rows == 1 or sum(map(len, p.column(2).to_pylist())) <= most for p in parts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(st.sampled_from("aB1é漢_ .\n\x7f\x80"), max_size=12) | st.text(max_size=8), max_size=6))
def test_terms_of_any_texts(texts):
    import pyarrow as pa

    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    words, at, n = S.terms_of(pa.array([None, *texts, "x"], pa.string()).slice(1, len(texts)))
    flat = [words[k].decode() for k in at]
    assert flat == [w for t in texts for w in cut(t)] and n.tolist() == [len(cut(t)) for t in texts]


def test_heap_keeps_the_first_of_equals():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    heap, every = S.Heap(10), []
    for w in range(20):
        scores = rng.integers(0, 5, 50)
        heap.harvest(scores, np.arange(50), pa.array(range(w * 50, w * 50 + 50)), w * 50)
        every += scores.tolist()
    assert sorted((-s, i) for s, _, i in heap.held) == sorted((-s, i) for i, s in enumerate(every))[:10]


def test_edge_cases(spark, edge, none):
    items = spark.createDataFrame([(1, "alpha word", "clash"), (2, None, ""), (3, "É 漢字", "x")], "item_id long, text string, doc_id string")
    want = plain([(r["doc_id"], r["text"]) for r in edge.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows(S.search(edge, items)) == want
    assert not S.search(none, items).count() and not S.search(edge, items.where("false")).count()
    named = edge.withColumn("doc_id", edge.doc_id.cast("string"))
    assert S.search(named, items).count() == len(want)
