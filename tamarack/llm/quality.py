"""Quality rules with risk-controlled thresholds.

Each rule scores a document by a rate in [0, 1] and rejects it above a cutoff. Cutoffs are chosen per stratum (language)
from labelled holdout documents: on the grid 1, 1 - 1/GRID, ... the hypothesis "over alpha / rules of this stratum's good
documents are rejected" is tested by the exact binomial tail, most lenient cutoff first, and the first cutoff whose
hypothesis isn't refuted ends the walk (fixed-sequence testing). Each walk runs at delta / (strata * rules) (Bonferroni),
so with probability 1 - delta no stratum loses more than a share alpha of its good documents to the learned rules.
A stratum without enough good labels for a proof keeps the cutoff 1, which rejects nothing.

All labelled rows are used: the counts behind the tests are histograms, summed in the cluster before anything is decided.

Defined results: a null text has no words and fails the base; a null language is the stratum ''; a document without a
label takes the cutoffs of its stratum; a stratum or table without labels rejects nothing beyond the base; a repeated
label row counts as often as it stands; labels without a doc_id or a quality count for nothing; repeated documents each
return a row; an empty table returns no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, take_turn

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
GRID, ALPHA, DELTA = 50, 0.02, 0.05
RULES = ("symbol_rate", "dup_line_rate", "repeat_rate")
FEATURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint"
_MUL = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside a window of size words that stands in the text twice or more, its first place included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mix = np.zeros(n, np.uint64)
    for k in range(size):
        mix = mix * _MUL + h[k : k + n]
    order = np.argsort(mix, kind="stable")
    same = mix[order[1:]] == mix[order[:-1]]
    if not same.any():
        return 0
    places: dict[bytes, list[int]] = {}  # equal hashes only nominate; the words decide
    for i in np.sort(order[np.append(same, False) | np.append(False, same)]).tolist():
        places.setdefault(b" ".join(words[i : i + size]), []).append(i)
    edge = np.zeros(len(words) + 1, np.int64)
    for at in places.values():
        if len(at) > 1:
            np.add.at(edge, at, 1)
            np.add.at(edge, np.array(at) + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The FEATURES of one text in UTF-8."""
    text = text or b""
    words = text.split()
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    blank = int(of[9:14].sum() + of[32])
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(text) - int(of[128:192].sum()) - blank, int(of[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words), len(lines))


def features_of(text: Column) -> Column:
    """FEATURES of each text. Marked as nondeterministic (which it isn't), so that the planner doesn't move a condition on it below a
    join and measure each text once more there: both would run in one task, each in a worker process of its own, and worker
    processes stay for what comes later."""

    @F.arrow_udf(FEATURES)
    def run(texts: pa.Array) -> pa.Array:
        take_turn("quality")
        rows = np.array([measure(t.as_py()) for t in texts], np.int64).reshape(-1, 6)
        return pa.StructArray.from_arrays([pa.array(c) for c in rows.T.copy()], [x.split()[0] for x in FEATURES.split(", ")])

    return run.asNondeterministic()(text.cast("binary"))


def measured(docs: DataFrame, text_col: str) -> Column:
    """The FEATURES of each row: its column __f, or measured from the text."""
    return F.col("__f") if "__f" in docs.columns else features_of(F.col(text_col))


def base_failed(f: Column) -> Column:
    return (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])


def scores(f: Column) -> dict[str, Column]:
    """Each rule's rate as a grid step 0..GRID, rounded up, so that a step exceeds cutoff c exactly if the rate does."""
    rate = lambda a, b: F.least(F.lit(GRID), F.ceil(a * GRID / F.greatest(b, F.lit(1)))).cast("int")
    return {
        "symbol_rate": rate(f["n_symbols"], f["word_chars"]),
        "dup_line_rate": rate(f["n_dup_lines"], f["n_lines"]),
        "repeat_rate": rate(f["n_repeat_words"], f["n_words"]),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), summed downwards from k until terms vanish."""
    if k >= n:
        return 1.0
    if k > n * p:
        return 1.0  # at least 1/2 - and no proof that the rate is below p
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    while k >= 0 and term > total * 1e-17:
        total += term
        term *= k * (1 - p) / ((n - k + 1) * p)
        k -= 1
    return min(1.0, total)


def choose_cutoff(counts: np.ndarray, alpha: float, level: float) -> int:
    """counts[s]: good documents at grid step s. The strictest step c such that every cutoff from GRID down to c is proved
    to reject (steps above c) at most a share alpha of good documents, each test at this level."""
    n, above, cutoff = int(counts.sum()), 0, len(counts) - 1
    for c in range(len(counts) - 1, -1, -1):
        if n == 0 or binomial_tail(above, n, alpha) > level:
            break
        cutoff = c
        above += int(counts[c])
    return cutoff


def fit_cutoffs(docs: DataFrame, labels: DataFrame, text_col: str = "text", stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum and a cutoff (grid step) per rule, from the documents that labels (doc_id, quality) calls good."""
    good = labels.where("quality = 1 and doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("__w"))
    # measured before the join, so that six numbers move and no text does
    held = docs.where("doc_id is not null").select("doc_id", F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), measured(docs, text_col).alias("f")).join(good, "doc_id")
    steps = held.select("stratum", "__w", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), s.alias("step")) for r, s in scores(F.col("f")).items()])).alias("x"))
    hist = materialize(steps.groupBy("stratum", "x.rule", "x.step").agg(F.sum("__w").alias("n")), "quality-hist")
    level = delta / (len(RULES) * max(1, hist.select("stratum").distinct().count()))

    def choose(rows: pa.Table) -> pa.Table:
        counts = np.zeros(GRID + 1, np.int64)
        np.add.at(counts, rows["step"].to_numpy(), rows["n"].to_numpy())
        return pa.table({"stratum": rows["stratum"][:1], "rule": rows["rule"][:1], "cutoff": pa.array([choose_cutoff(counts, alpha / len(RULES), level)], pa.int32())})

    # Arrow in place of pandas, which would cost every worker process some 40 MB for these few rows
    cut = hist.groupBy("stratum", "rule").applyInArrow(choose, "stratum string, rule string, cutoff int")
    return cut.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__cut_{r}") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", stratum_col: str = "lang", **params) -> DataFrame:
    """docs with __f (struct of FEATURES; measured from the text unless docs has it), __base_failed and __kept."""
    cut = materialize(fit_cutoffs(docs, labels, text_col, stratum_col, **params), "quality-cutoffs").withColumnRenamed("stratum", "__s")
    rows = docs.withColumn("__s", F.coalesce(F.col(stratum_col).cast("string"), F.lit("")))
    # a row per language: broadcast where its size is seen to be small, else the planner joins by key
    rows = (rows.join(F.broadcast(cut), "__s", "left") if cut.count() <= 10_000 else rows.join(cut, "__s", "left")).withColumn("__f", measured(docs, text_col))
    over = F.lit(False)
    for r, s in scores(F.col("__f")).items():
        over = over | (s > F.coalesce(F.col(f"__cut_{r}"), F.lit(GRID)))
    rows = rows.withColumn("__base_failed", base_failed(F.col("__f")))
    return rows.withColumn("__kept", ~F.col("__base_failed") & ~over).select(*[c for c in docs.columns if c != "__f"], "__f", "__base_failed", "__kept")


def keep_good(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The rows of docs that pass, with their columns."""
    return judge(docs, labels, **params).where("__kept").select(*docs.columns)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # each text is measured once; cutoffs and verdicts come from the written numbers
    docs = materialize(table(spark, sf_dir, "documents").select("doc_id", "lang", features_of(F.col("text")).alias("__f")), "quality-features")
    f = [F.col(f"__f.{x}").alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judge(docs, table(spark, sf_dir, "labels")).select("doc_id", *f, F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))
