import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tamarack.llm import common, simhash

from .conftest import SF


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(ids, fps, most=3):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_equals_brute_force(spark, documents):
    got = simhash.op1_simhash(spark, SF).toPandas().sort_values("doc_id")
    fps = [plain(t) for t in documents.text]
    want = dict(zip(documents.doc_id, zip(fps, groups(list(documents.doc_id), fps), strict=True), strict=True))
    assert [(int(f, 16), c) for f, c in zip(got.fingerprint, got.component_id)] == [want[d] for d in got.doc_id]
    assert len(got) == len(documents) and (got.doc_id != got.component_id).any()


def test_edge_cases(edge, none):
    rows = simhash.near_groups(edge).collect()
    assert len(rows) == edge.count() and not simhash.near_groups(none).count()
    by = {}
    for r in rows:
        by.setdefault(r["id"], set()).add((r["fp"] & (1 << 64) - 1, r["component_id"]))
    assert by[2] == by[3] == by[4] == {(0, 2)}
    assert by[5] == by[1] and next(iter(by[1]))[1] == 1
    assert next(iter(by[None]))[1] is None
    kept = simhash.dedup(edge)
    assert kept.columns == edge.columns and kept.where("doc_id in (3, 4, 5)").count() == 0 and kept.where("doc_id is null").count() == 1


def test_large_bucket_is_cut_into_cells(spark):
    random.seed(3)
    base = random.getrandbits(64)
    fps = {base}
    while len(fps) < 500:
        x = random.choice(sorted(fps)) if random.random() < 0.7 else base
        for _ in range(random.randint(1, 4)):
            x ^= 1 << random.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    frame = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    masks = common.block_masks(6, 3)
    assert len(masks) == 20
    cells = common.bucket_cells(frame, "fp", masks, 16).groupBy("__t", "__k", "__c").count()
    assert cells.agg(F.max("count")).first()[0] < 120
    signed = [simhash._signed(x) for x in fps]
    want = dict(zip(signed, groups(signed, fps), strict=True))
    for rows in (common.CELL_ROWS, 16):  # 16: every bucket of note is cut into cells
        roots = {r["node"]: r["root"] for r in common.components(common.hamming_forest(frame, "fp", 6, 3, rows)).collect()}
        for x in signed:
            assert want[roots.get(x, x)] == want[x]
        assert len({roots.get(x, x) for x in signed}) == len(set(want.values()))


def similar(ids, texts, least=0.8, size=5):
    """The smallest id reachable over texts whose shingle sets have this Jaccard similarity, all pairs compared."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [re.findall(r"[^\x20\x09-\x0D]+", t.translate(table)) for t in texts]
    sets = [{tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)} for w in words]
    name = dict(zip(ids, ids, strict=True))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if min(len(a), len(b)) >= least * max(len(a), len(b)) and len(a & b) >= least * len(a | b):
                x, y = find(ids[i]), find(ids[j])
                name[max(x, y)] = min(x, y)
    return [find(i) for i in ids]


def test_similar_groups(spark, documents):
    rng = random.Random(12)
    vocab = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "rt", "st")]
    docs = list(zip(documents.doc_id.tolist(), documents.text.tolist(), strict=True))
    near = []
    for k in range(150):  # copies between 0.8 and 1
        words = rng.choices(vocab, k=rng.choice([40, 120, 400, 1500]))
        copy = list(words)
        for i in rng.sample(range(len(words)), max(1, len(words) // rng.choice([55, 80, 200]))):
            copy[i] = rng.choice(vocab)
        near.append((100_000 + 2 * k, " ".join(words)))
        near.append((100_001 + 2 * k, " ".join(copy).upper()))
    for rows in (docs, near):
        ids, texts = [d for d, _ in rows], [t or "" for _, t in rows]
        want = dict(zip(ids, similar(ids, texts), strict=True))
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = {r["id"]: r["component_id"] for r in simhash.similar_groups(frame, cell_rows=8).collect()}
        assert set(got) == set(want)
        links = sum(a != b for a, b in want.items())
        assert all(want[got[d]] == want[d] for d in got)  # nothing is linked wrongly
        assert links and sum(got[d] == want[d] for d in got if want[d] != d) >= 0.9 * links


def test_majority():
    h = np.array([random.getrandbits(64) for _ in range(777)], np.uint64)
    want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))
    assert simhash.majority(h) == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "u long, v long")
    roots = {r["node"]: r["root"] for r in common.components(edges).collect()}
    assert roots == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}
