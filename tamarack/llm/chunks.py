"""Substring dedup by content-defined chunks.

A gear hash rolls over the UTF-8 bytes: h = (h << 1) + GEAR[byte], so that bit j depends on the last j + 1 bytes only. A
place where the mask bits are zero is a candidate; it is a cut unless another candidate lies in the MIN bytes before it. Both
rules look at a bounded number of bytes to the left, so equal passages are cut at equal places after their first bytes,
whatever was inserted before them, and no earlier choice has to be undone. Stretches without a cut are divided every MAX
bytes from their start.

A chunk that also stands earlier (smaller doc_id, or the same document further left), by 128-bit digest, is a repeat. Repeats
next to each other are removed as a run if the run has MIN_RUN bytes at least: single small chunks recur by chance.

Copies are found by an aggregate per digest, so a chunk that a third of all documents share is one row per task before it is
shuffled; the chunks are written once, in the shared folder, and read for that aggregate and for the join with its result. Defined results: a null text stays null and an empty one empty; texts of any length are cut whole; rows without
doc_id are left as they are and remove nothing elsewhere; rows that repeat a doc_id and a text are one document that stands
several times (what repeats only between them stays), rows that repeat a doc_id with another text are documents of their own, in
order of the text's hash; ids may be of any type with an order; a removed run that ends inside a character takes the whole character; an empty
table returns no rows; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, numbered, table

MIN, MAX, MIN_RUN = 16, 192, 40
#: Four mask bits: a candidate every 16 bytes on average. Bits 28 to 31 look at the last 32 bytes at most.
MASK, WINDOW = 0xF0000000, 32


@cache
def gear() -> np.ndarray:
    """256 fixed random numbers of 32 bits: hashes of the byte values."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 20) for b in range(256)], np.uint32)


def cuts(data: bytes, least: int = MIN, most: int = MAX) -> np.ndarray:
    """The ends of the chunks, in order; the last is the length."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    h = gear()[np.frombuffer(data, np.uint8)]
    span = 1
    while span < WINDOW:  # sums over 2, 4, ... bytes: h[i] + (h[i - span] << span)
        h[span:] = h[span:] + (h[:-span] << np.uint32(span)) if span < n else h[span:]
        span *= 2
    at = np.flatnonzero(h & np.uint32(MASK) == 0) + 1
    at = at[np.diff(at, prepend=-least) >= least]
    at = at[at < n]
    edges = np.concatenate([[0], at, [n]])
    size = np.diff(edges)
    if (size > most).any():
        parts = -(-size // most)
        first = np.repeat(edges[:-1], parts)
        step = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
        edges = np.append(first + step * most, n)
    return edges[1:]


#: Chunks that are handed on at a time.
SLICE = 20_000


def _slice(ids: list, sizes: list[np.ndarray], ends: list[np.ndarray], sums: list[bytes]) -> pa.RecordBatch:
    """id, start, size, d1, d2, again of the chunks of some documents; again: the document has an equal chunk further left."""
    doc = np.repeat(np.arange(len(ids)), [len(e) for e in ends])
    end, size = np.concatenate(ends), np.concatenate(sizes)
    d = np.frombuffer(b"".join(sums), "<i8").reshape(-1, 2)
    order = np.lexsort((end, d[:, 1], d[:, 0], doc))
    x, y, z = doc[order], d[order, 0], d[order, 1]
    again = np.zeros(len(doc), bool)
    again[order[1:]] = (x[1:] == x[:-1]) & (y[1:] == y[:-1]) & (z[1:] == z[:-1])
    arrays = [np.array(ids, np.int64)[doc], end - size, size.astype(np.int32), d[:, 0].copy(), d[:, 1].copy(), again]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], ["id", "start", "size", "d1", "d2", "again"])


def chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, start, size, d1, d2 (digest), again of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        ids, sizes, ends, sums, held = [], [], [], [], 0
        for b in batches:
            for i in range(b.num_rows):
                data = b.column(1)[i].as_py()
                end = cuts(data)
                if not len(end):
                    continue
                size = np.diff(end, prepend=0)
                sums += [digest(data[y - n : y]) for y, n in zip(end.tolist(), size.tolist(), strict=True)]
                ids.append(b.column(0)[i].as_py())
                sizes.append(size)
                ends.append(end)
                held += len(end)
                if held >= SLICE:
                    yield _slice(ids, sizes, ends, sums)
                    ids, sizes, ends, sums, held = [], [], [], [], 0
        if held:
            yield _slice(ids, sizes, ends, sums)

    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "id bigint, start bigint, size int, d1 bigint, d2 bigint, again boolean")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """id, runs: array of (start, size) in bytes of what each document repeats; documents without any are left out."""
    chunks = materialize(chunk_table(docs, id_col, text_col), "chunk-table")
    # what a document repeats of itself is known already; between documents the smallest id has the first copy. Two numbers
    # for each digest: a hash aggregate that combines before it shuffles
    seen = chunks.where("not again").groupBy("d1", "d2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    repeats = materialize(seen.where("first <> last").select("d1", "d2", "first"), "chunks")
    # a digest's copies sit with its one row of repeats; the planner broadcasts that side or splits the copies
    later = chunks.join(repeats, ["d1", "d2"], "left").where("again OR id <> first").select("id", "start", "size")
    per = later.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("__c"))
    return per.select("id", merge_runs("__c", min_run).alias("runs")).where("size(runs) > 0")


def merge_runs(column: str, min_run: int):
    """The chunks of a document, sorted, as runs; rows that repeat a document bring the same chunk twice."""

    @F.arrow_udf("array<struct<start:bigint,size:bigint>>")
    def run(rows: pa.Array) -> pa.Array:
        out = []
        for r in rows:
            merged: list[dict] = []
            for c in r.as_py():
                end = c["start"] + c["size"]
                if merged and c["start"] <= merged[-1]["start"] + merged[-1]["size"]:
                    merged[-1]["size"] = max(merged[-1]["size"], end - merged[-1]["start"])
                else:
                    merged.append({"start": c["start"], "size": c["size"]})
            out.append([m for m in merged if m["size"] >= min_run])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())])))

    return run(column)


def without_runs(data: bytes, runs: list[dict]) -> bytes:
    """data without the runs, each widened to whole characters."""
    out, at = [], 0
    for r in runs:
        start, end = r["start"], r["start"] + r["size"]
        while start > at and start < len(data) and data[start] & 0xC0 == 0x80:
            start -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        out.append(data[at : max(at, start)])
        at = max(at, end)
    return b"".join([*out, data[at:]])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """docs with the repeated runs taken out of the text."""
    rows = numbered(docs, id_col, text_col, "chunks")
    runs = repeated_runs(rows, "__doc", text_col, min_run).select(F.col("id").alias("__id"), F.col("runs").alias("__runs"))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), gone.to_pylist(), strict=True)
        return pa.array([t if t is None or not g else without_runs(t.encode(), g).decode() for t, g in pairs], pa.string())

    rows = rows.join(runs, F.col("__doc") == F.col("__id"), "left")
    return rows.withColumn(text_col, cut(F.col(text_col), F.col("__runs"))).select(*docs.columns)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the spans (start:size, in bytes) for each document."""
    docs = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", "chunks")
    runs = repeated_runs(docs, "__doc").select(F.col("id").alias("__id"), F.col("runs").alias("__runs"))
    rows = docs.join(runs, F.col("__doc") == F.col("__id"), "left")

    @F.arrow_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans string")
    def report(texts: pa.Array, gone: pa.Array) -> pa.Array:
        out = []
        for t, g in zip(texts.to_pylist(), gone.to_pylist(), strict=True):
            data, g = t or b"", g or []
            kept = without_runs(data, g)
            out.append((len(data), len(data) - len(kept), len(g), hashlib.sha256(kept).hexdigest(), ",".join(f"{r['start']}:{r['size']}" for r in g)))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2, strict=True)], ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows.select("doc_id", report(F.col("text").cast("binary"), F.col("__runs")).alias("r")).select("doc_id", "r.*")
