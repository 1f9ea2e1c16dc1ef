import hashlib
import random

from tamarack.llm import chunks

from .conftest import SF


def plain(docs):
    """id -> runs, with every chunk of every document in one dictionary."""
    places, rows = {}, []
    for d, t in docs:
        at, data = 0, t.encode()
        for end in chunks.cuts(data).tolist():
            rows.append((d, at, end, data[at:end]))
            places[data[at:end]] = min((d, at), places.get(data[at:end], (d, at)))
            at = end
    gone = {}
    for d, a, b, x in sorted(set(rows)):
        if places[x] != (d, a):
            runs = gone.setdefault(d, [])
            if runs and runs[-1][1] == a:
                runs[-1][1] = b
            else:
                runs.append([a, b])
    return {d: [(a, b - a) for a, b in r if b - a >= chunks.MIN_RUN] for d, r in gone.items()}


def test_query_equals_brute_force(spark, documents):
    want = plain(zip(documents.doc_id, documents.text))
    got = chunks.op3_substring_dedup(spark, SF).collect()
    assert len(got) == len(documents)
    text = dict(zip(documents.doc_id, documents.text))
    for r in got:
        runs = want.get(r["doc_id"], [])
        kept = chunks.without_runs(text[r["doc_id"]].encode(), [{"start": a, "size": n} for a, n in runs])
        assert r["spans"] == ",".join(f"{a}:{n}" for a, n in runs) and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        kept.decode()
    assert sum(r["n_removed"] for r in got)


def test_cuts_resist_shifts():
    rng = random.Random(1)
    say = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n)).encode()
    missed = 0
    for _ in range(200):
        passage = say(300)
        a, b = (say(rng.randint(0, 500)) for _ in range(2))
        x, y = ({bytes(d[i:j]) for i, j in zip([0, *c], c)} for d in (a + passage + say(50), b + passage + say(50)) for c in [chunks.cuts(d).tolist()])
        missed += not x & y
    assert missed <= 6
    data = say(10_000)
    c = chunks.cuts(data).tolist()
    assert c[-1] == len(data) and max(j - i for i, j in zip([0, *c], c)) <= chunks.MAX and chunks.cuts(b"").tolist() == []


def test_repeated_passages_are_found(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    passage = say(55)
    docs = [(i, say(80) + " " + (passage + " " + say(30) if i % 3 == 0 else say(60))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = {r["id"]: sum(x["size"] for x in r["runs"]) for r in chunks.repeated_runs(frame).collect()}
    assert set(found) == {i for i in range(3, 60, 3)} and min(found.values()) > len(passage) // 3
    kept = {r["doc_id"]: r["text"] for r in chunks.dedup_substrings(frame).collect()}
    assert kept[0] == docs[0][1] and kept[1] == docs[1][1] and len(kept[3]) < len(docs[3][1])


def test_edge_cases(spark, edge, none):
    out = chunks.dedup_substrings(edge)
    assert out.columns == edge.columns and out.count() == edge.count() and not chunks.dedup_substrings(none).count()
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[2] is None and text[3] == "" and text[4] == " \t\n " and text[1] == "alpha beta gamma delta" and len(text[7]) < 1100
    assert chunks.without_runs("aéz".encode(), [{"start": 0, "size": 2}]) == b"z"


def test_rows_that_share_an_id_keep_what_is_theirs(spark, shared_ids):
    a, b, c, df = shared_ids
    for docs in (df, df.selectExpr("'k' || doc_id AS doc_id", "text")):
        rows = sorted((str(r["doc_id"])[-1], r["text"]) for r in chunks.dedup_substrings(docs).collect() if r["text"] is not None)
        own = [t for k, t in rows if k == "2"]
        assert b in own and [t for k, t in rows if k == "1"] == [a]  # the text that stands under another one's id stays
        assert sorted(len(t) for k, t in rows if k == "4") == [0, 399]
        assert sum(t.count(c) for _, t in rows) >= 1 and docs.count() == len(rows) + 1
