import hashlib
import random
import re

from tamarack.llm import decontaminate as dc

from .conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - 9) if len(w) >= 10 else [0] * bool(w):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, who = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    who |= found
        ids = sorted(str(x) for x in who if x is not None)
        out.append((d, len(w), len(hit), len(ids), ids))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def test_query_equals_brute_force(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, dc.op10_decontamination(spark, SF).collect()))
    want = [(d, n, h, k, hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0) for d, n, h, k, ids in plain(zip(documents.doc_id, documents.text), items)]
    assert got == want and any(r[5] for r in got)


def corpus(spark):
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = [(i, say(n)) for i, n in enumerate([4, 9, 10, 11, 30, 200, 0, 5])] + [(None, say(12)), (3, say(15))]
    docs = []
    for i in range(120):
        parts = [say(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1].split()
            at = rng.randint(0, max(0, len(w) - 10))
            parts += [" ".join(w[at : at + rng.randint(8, 25)]), say(rng.randint(0, 12))]
        docs.append((i, ", ".join(parts).title()))
    docs += [(5, docs[5][1]), (None, items[4][1])]
    return spark.createDataFrame(docs, "doc_id long, text string"), docs, spark.createDataFrame(items, "item_id long, text string"), items


def test_short_items_ties_and_both_ways(spark, monkeypatch):
    frame, docs, bench, items = corpus(spark)
    want = sorted(plain(docs, items), key=key)
    clean = sorted((r[0] for r in want if not r[2]), key=lambda x: (x is None, x or 0))
    for most in (20_000, 5):  # constants in the plan, then the join
        monkeypatch.setattr(dc, "MAX_LITERALS", most)
        assert sorted(map(tuple, dc.decontaminate(frame, bench).collect()), key=key) == want
        assert sorted((r[0] for r in dc.drop_contaminated(frame, bench).collect()), key=lambda x: (x is None, x or 0)) == clean


def test_no_python_in_the_plan(spark):
    frame, _, bench, _ = corpus(spark)
    plan = dc.decontaminate(frame, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_edge_cases(spark, edge, none):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, None), (3, "")], "item_id long, text string")
    rows = dc.decontaminate(edge, bench).collect()
    assert len(rows) == edge.count() and {r["id"] for r in rows if r["n_hit"]} == {1, 5}
    assert not dc.decontaminate(none, bench).count() and not dc.decontaminate(edge, bench.where("false")).where("n_hit > 0").count()
    kept = dc.drop_contaminated(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 3
