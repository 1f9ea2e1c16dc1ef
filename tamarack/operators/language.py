"""Language detection by log-odds of character trigrams, fitted on rows whose language is known.

Texts are lower-cased and their white space squeezed by Spark; trigrams are counted and looked up in Arrow batches, where a
trigram is one whole number, as exploding every character of a corpus into a row costs some ten times as much. Counts are summed
by Spark. A model has at most GRAMS trigrams (the most frequent, of equal ones the smaller) and LANGUAGES languages, so that it
can be sent to every worker whatever the corpus.

The weight of a trigram for a language is floor(1000 ln(odds there / odds elsewhere)), counts one larger than they are; a text
is of the language with the largest sum over its trigrams, of equal ones the first by name. A text without a trigram of the model
(null, empty, under three characters) has none."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import settled

GRAMS, LANGUAGES = 20_000, 200
#: Characters that are taken apart at a time.
SLICE_CHARS = 2_000_000


def plain_text(text: Column) -> Column:
    """Lower case, each run of white space one blank."""
    return F.regexp_replace(F.lower(text), "[ \\t\\n\\r\\f]+", " ")


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of all texts as whole numbers, and how many each text has."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if len(c) < 3:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    code = c[:-2] << 42 | c[1:-1] << 21 | c[2:]
    ends = np.cumsum(sizes)
    own = np.ones(len(c), bool)  # what would begin at a text's last two characters isn't one of its own
    for back in (1, 2):
        at = ends[sizes >= back] - back
        own[at] = False
    return code[own[:-2]], np.maximum(sizes - 2, 0)


def _slices(column: pa.Array, most: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Place of the first and the texts, some at a time; nulls as empty texts."""
    part, size, at = [], 0, 0
    for k, t in enumerate(column):
        part.append(x := t.as_py() or "")
        size += len(x)
        if size >= most:
            yield at, part
            part, size, at = [], 0, k + 1
    if part:
        yield at, part


def trigram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, code, n: how often each trigram stands in the texts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in _slices(b.column(1)):
                names = b.column(0).slice(at, len(texts)).dictionary_encode()
                code, n = _trigrams(texts)
                of = np.repeat(names.indices.to_numpy(), n)
                for k, name in enumerate(names.dictionary.to_pylist()):
                    grams, count = np.unique(code[of == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(count)], ["lang", "code", "n"])

    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), plain_text(F.col(text)).alias("text"))
    return rows.mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text: str, lang: str, grams: int = GRAMS) -> DataFrame:
    """gram, code, lang, weight for each trigram of the model and each language. More than LANGUAGES languages raise ValueError."""
    counts = settled(trigram_counts(df, text, lang), "trigrams")
    best = counts.groupBy("code").agg(F.sum("n").alias("all")).orderBy(F.desc("all"), "code").limit(grams)
    spark = df.sparkSession
    if counts.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    rows = counts.join(F.broadcast(best), "code").toArrow()  # at most trigrams times languages
    codes, place = np.unique(rows.column("code").to_numpy(), return_inverse=True)
    names = sorted(set(rows.column("lang").to_pylist()))
    n = np.zeros((len(names), len(codes)), np.int64)
    n[[names.index(x) for x in rows.column("lang").to_pylist()], place] = rows.column("n").to_numpy()
    total, here = n.sum(), n.sum(axis=1, keepdims=True)
    odds = (n + 1.0) / (n.sum(axis=0) - n + 1.0) * ((total - here + len(codes)) / (here + float(len(codes))))
    weight = np.floor(1000 * np.log(odds)).astype(np.int32)
    spelled = ["".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in codes.tolist()]
    table = pa.table({"gram": pa.array(spelled * len(names), pa.string()), "code": pa.array(np.tile(codes, len(names))), "lang": pa.array(np.repeat(names, len(codes)).tolist(), pa.string()), "weight": pa.array(weight.ravel())})
    return spark.createDataFrame(table)


def detect(df: DataFrame, model: DataFrame, text: str, name: str = "detected") -> DataFrame:
    """df with the language of each text by the model."""
    rows = model.select("code", "lang", "weight").toArrow()
    codes, place = np.unique(rows.column("code").to_numpy(), return_inverse=True)
    names = sorted(set(rows.column("lang").to_pylist()))
    weight = np.zeros((len(names), len(codes) + 1), np.int32)  # the last for trigrams outside the model
    weight[[names.index(x) for x in rows.column("lang").to_pylist()], place] = rows.column("weight").to_numpy()
    sent = df.sparkSession.sparkContext.broadcast((codes, names, weight))

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array) -> pa.Array:
        known, called, of = sent.value
        out: list[str | None] = []
        for _, part in _slices(texts):
            code, n = _trigrams(part)
            at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
            at = np.where(known[at] == code, at, len(known)) if len(known) else np.zeros(len(code), np.int64)
            row = np.repeat(np.arange(len(part)), n)
            hits = np.bincount(row[at < len(known)], minlength=len(part))
            if called:
                sums = np.stack([np.bincount(row, w[at], len(part)) for w in of])  # whole numbers below 2^53: exact
                best = sums.argmax(axis=0)
                out += [called[b] if h else None for b, h in zip(best.tolist(), hits.tolist(), strict=True)]
            else:
                out += [None] * len(part)
        return pa.array(out, pa.string())

    return df.withColumn(name, run(plain_text(F.col(text))))
