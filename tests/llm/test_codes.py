import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarack.llm import codes as C

from .conftest import SF


def plain(rows, parts=4, entries=256, rounds=4):
    """(id, vector, label) by the rules, every part against every entry."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            for e, xs in groups.items():
                books[p][e] = [sum(x) // len(xs) for x in zip(*xs)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = defaultdict(int)
    for (*_, label), f in zip(kept, found):
        errors[label] += sum(x for x, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(x for x, _ in f), errors[label], sha) for (i, _, label), f in zip(kept, found)), key=repr)


def query(df, **options):
    codes, books = C.compress(df, **options)
    return sorted(((r["id"], bytes(r["code"]).hex(), r["error"], r["label_error"], C.digest(books)) for r in C.with_label_error(codes).collect()), key=repr)


@pytest.mark.parametrize("folder", [SF, SF.replace("0.001", "0.01")])
def test_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    cur = con.execute(C.SQL)
    got = C.op13_vector_codes(spark, folder)
    assert [x[0] for x in cur.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def test_nulls_ties_and_repeats(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i) // 2, rng.normal(size=8).round(1).tolist(), int(i) % 3 if i % 5 else None) for i in range(120)]
    rows += [rows[3]] * 40 + [(None, [0.5] * 8, 1), (None, [-0.25] * 8, None), (500, None, 1), (501, [1.0] * 7 + [None], 1), (502, [float("nan")] * 8, 2), (503, [float("inf")] + [0.0] * 7, 2), (504, [float("-inf")] + [0.0] * 7, 2)]
    df = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int, v int").repartition(3)
    assert query(df) == plain(rows)
    assert query(df, parts=2, entries=5, rounds=2) == plain(rows, 2, 5, 2)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(0, 2**32 - 1), st.sampled_from([3, 40, 1 << 10, 1 << 21, 1 << 25]), st.integers(1, 5))
def test_filter_finds_the_nearest(n, width, seed, span, bits):
    rng = np.random.default_rng(seed)
    book, x = rng.integers(-span, span, (n, width)), rng.integers(-span, span, (60, width))
    code, far = C.Cells(book, bits, exact=span > 1 << 21).nearest(x)
    every = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert code.tolist() == every.argmin(axis=1).tolist() and far.tolist() == every.min(axis=1).tolist()


def test_filter_leaves_most_entries_out(spark):
    """On the given vectors the exact distances are needed for a small share of the entries only."""
    rows = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/embeddings.parquet").orderBy("vec_id").select("embedding").collect()
    x = np.floor(np.array([r[0] for r in rows], np.float64) * 1024).astype(np.int64)[:, :16]
    cells = C.Cells(x[:256])
    assert len(cells.candidates(x[256:])[0]) < 0.15 * 256 * len(x[256:])


def test_edge_cases(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert not query(spark.createDataFrame([], kind)) and not query(spark.createDataFrame([(1, None, 1)], kind))
    assert query(spark.createDataFrame([(1, [], 1), (2, [], None)], kind)) == [(1, "00000000", 0, 0, C.digest([])), (2, "00000000", 0, 0, C.digest([]))]
    for bad in ([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 6, 1)], [(1, [1e9] * 4, 1)]):
        with pytest.raises(ValueError):
            C.compress(spark.createDataFrame(bad, kind))
    named = spark.createDataFrame([("a", [1.0] * 4, "l"), ("b", [2.0] * 4, None)], "vec_id string, embedding array<float>, label string")
    assert [r[:3] for r in query(named)] == [("a", "00000000", 0), ("b", "01010101", 0)]
