import re
from math import comb

import numpy as np

from tamarack.llm import quality

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            lines += x in seen
            seen.add(x)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(set(windows)) < len(windows) else set()
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(hit))


def test_query_equals_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in quality.op2_quality_rules(spark, SF).collect()}
    assert len(got) == len(documents)
    for d, t in zip(documents.doc_id, documents.text):
        r, want = got[d], plain(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])


def test_binomial_tail_is_exact():
    for n, k, p in [(10, 0, 0.3), (50, 3, 0.1), (400, 1, 0.02), (200, 4, 0.05)]:
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(quality.binomial_tail(k, n, p) - want) < 1e-12


def test_cutoffs_keep_their_promise():
    rng = np.random.default_rng(5)
    alpha, level, broken = 0.05, 0.1, 0
    for _ in range(400):  # true rejection rate above step c is (GRID - c) / GRID
        counts = np.bincount(rng.integers(1, quality.GRID + 1, 600), minlength=quality.GRID + 1)
        c = quality.choose_cutoff(counts, alpha, level)
        broken += (quality.GRID - c) / quality.GRID > alpha
    assert broken <= 400 * level * 1.5
    assert quality.choose_cutoff(np.zeros(quality.GRID + 1, np.int64), alpha, level) == quality.GRID


def test_learned_rule_rejects_junk_and_spares_good(spark):
    good = " ".join(f"w{i}" for i in range(40))
    junk = " ".join(f"w{i}###" for i in range(40))
    docs = spark.createDataFrame([(i, good if i % 4 else junk, "en") for i in range(4000)], "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "IF(doc_id % 4 = 0, 0, 1) AS quality", "0 AS toxic")
    out = quality.judge(docs, labels).groupBy((docs.doc_id % 4 == 0).alias("junk"), "__kept").count().collect()
    assert {(r["junk"], r["__kept"]): r["count"] for r in out} == {(True, False): 1000, (False, True): 3000}


def test_edge_cases(spark, edge, none):
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge(edge, labels).collect()
    assert len(rows) == edge.count() and not any(r["__kept"] for r in rows if r["doc_id"] in (2, 3, 4, 8))
    assert next(r for r in rows if r["doc_id"] == 7)["__f"]["n_words"] == 60_000
    assert not quality.judge(none, labels).count() and quality.judge(edge, labels.where("false")).count() == edge.count()
    assert quality.keep_good(edge, labels).columns == edge.columns


def test_verdict_equals_a_plain_fit(spark):
    """kept on a table with enough labels: cutoffs walked by hand with sums of binomial terms."""
    rng = np.random.default_rng(8)
    docs = []
    for i in range(3000):
        words = [f"w{i}x{k}" + "#" * int(rng.random() < rng.choice([0, 0.02, 0.3])) for k in range(30)]
        docs.append((i, " ".join(words) + ("\nline one\nline one" if rng.random() < 0.01 else ""), str(rng.choice(["en", "fr", "de"], p=[0.6, 0.39, 0.01]))))
    good = {i: int(rng.random() < 0.9) for i in range(0, 3000, 2)}
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["__kept"] for r in quality.judge(frame, spark.createDataFrame([(i, q, 0) for i, q in good.items()], "doc_id long, quality int, toxic int")).collect()}

    def steps(text):
        n_words, chars, symbols, dup, repeat = plain(text)
        n_lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
        up = lambda a, b: min(quality.GRID, -(-a * quality.GRID // max(b, 1)))
        return up(symbols, chars), up(dup, n_lines), up(repeat, n_words)

    level, alpha, cut = quality.DELTA / 9, quality.ALPHA / 3, {}
    for lang in ("en", "fr", "de"):
        seen = [steps(t) for i, t, la in docs if la == lang and good.get(i) == 1]
        for rule in range(3):
            cut[lang, rule] = quality.GRID
            for c in range(quality.GRID, -1, -1):
                above, n = sum(s[rule] > c for s in seen), len(seen)
                if above > n * alpha or sum(comb(n, k) * alpha**k * (1 - alpha) ** (n - k) for k in range(above + 1)) > level:
                    break
                cut[lang, rule] = c
    want = {i: plain(t)[0] >= 20 and 100 * plain(t)[4] <= 30 * plain(t)[0] and all(s <= cut[la, k] for k, s in enumerate(steps(t))) for i, t, la in docs}
    assert got == want and any(c < quality.GRID for c in cut.values()) and not all(want.values())


def test_each_text_is_measured_once(spark):
    """Beside the cutoffs, which are written: a second measure in the same tasks takes a second worker process for each of them."""
    docs = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = quality.keep_good(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
