"""Vector code compression: product codes whose nearest entries are found by VA-file filtering.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook. A round assigns every part to the
nearest entry of its codebook and moves the entries to the mean of their parts. Vectors are written once and read in each round;
each partition sums its parts by entry, so what is shuffled and what the driver takes (a codebook: parts times entries times
length) doesn't grow with the vectors.

Assignment filters first. Each coordinate of a codebook's entries is quantised to BITS bits: cells of about equally many entries,
each with the least and the largest coordinate in it. A part to be assigned has a lookup table for each coordinate: the least and
the largest squared difference to each cell. Their sums over an entry's cells bound its distance from below and above. Entries
whose lower bound is over the least upper bound are out; the distances of the others are computed in whole numbers, of equal ones
the lower index is taken. Table lookups are sums of a table by 0/1 matrices (one for each entry, the same for all parts), in
floating point; a margin of the rounding error is added to the bounds, so that they hold.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; a null id is behind all others when
the first entries are taken, equal ids are in order of their vectors; rows that repeat an id each return a row; fewer rows than
entries give a smaller codebook; null labels form one group; an empty table returns no rows; other columns are ignored. Vectors
of several lengths, of a length that the parts don't divide, or with components of 2^16 or more in absolute value raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Bits of a coordinate's cell, rows that are assigned at a time, largest component.
BITS, ROWS, LARGEST = 4, 2048, 1 << 16


class Cells:
    """The filter of one codebook: entries (int64, one row each)."""

    def __init__(self, entries: np.ndarray, bits: int = BITS, exact: bool = False):
        n, width = entries.shape
        self.entries, self.kind = entries, np.float64 if exact else np.float32
        count = 1 << bits
        self.low, self.high = (np.zeros((width, count), self.kind) for _ in range(2))
        self.pick = np.zeros((width * count, n), self.kind)
        for d in range(width):
            values = np.sort(entries[:, d])
            borders = values[np.arange(1, count) * n // count]
            cell = np.searchsorted(borders, entries[:, d], "right")
            for c in np.unique(cell).tolist():
                held = entries[cell == c, d]
                self.low[d, c], self.high[d, c] = held.min(), held.max()
            self.pick[d * count + cell, np.arange(n)] = 1
        #: Relative error of a sum of width squares, both bounds' share in one.
        self.margin = self.kind(1 + 2 * (width + 4) * np.finfo(self.kind).eps)

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of the entries that may be nearest, in order; at least one of each row."""
        at = x.astype(self.kind)[:, :, None]
        below, above = self.low - at, at - self.high
        least = np.maximum(np.maximum(below, above), 0)
        most = np.maximum(at - self.low, self.high - at)
        flat = (len(x), self.pick.shape[0])
        lower = (least * least).reshape(flat) @ self.pick
        upper = ((most * most).reshape(flat) @ self.pick).min(axis=1, keepdims=True)
        return np.nonzero(lower <= upper * self.margin)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the nearest entry and its squared distance."""
        row, entry = self.candidates(x)
        apart = x[row] - self.entries[entry]
        far = np.einsum("ij,ij->i", apart, apart)
        starts = np.searchsorted(row, np.arange(len(x)))
        best = np.minimum.reduceat(far, starts)
        at = np.flatnonzero(far == best[row])
        return entry[at[np.searchsorted(row[at], np.arange(len(x)))]], best


def parts_of(column: pa.Array, parts: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows of vectors, ROWS at a time: how many, and the part of each position."""
    for at in range(0, len(column), ROWS):
        some = column.slice(at, ROWS)
        x = some.flatten().to_numpy().astype(np.int64).reshape(len(some), parts, -1)
        yield len(some), [x[:, p] for p in range(parts)]


def refine(vectors: DataFrame, books: list[np.ndarray], largest: int) -> list[np.ndarray]:
    """The books after one round: entries moved to the componentwise floor of the mean of their parts; unused ones stay."""
    parts, width = len(books), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, exact=exact) for b in books]
        total = [np.zeros((width + 1, len(b)), np.int64) for b in books]
        for batch in batches:
            for _, xs in parts_of(batch.column(0), parts):
                for p, x in enumerate(xs):
                    code, n = cells[p].nearest(x)[0], len(books[p])
                    order = np.argsort(code, kind="stable")
                    used, first = np.unique(code[order], return_index=True)
                    total[p][:-1, used] += np.add.reduceat(x[order], first, axis=0).T
                    total[p][-1] += np.bincount(code, minlength=n)
        for p, t in enumerate(total):
            used = np.flatnonzero(t[-1])
            if len(used):
                sums = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(t[:-1, used].T).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(t[-1, used]), sums], ["part", "entry", "n", "sums"])

    exact = largest >= 1 << 22  # differences of smaller whole numbers are exact in 32 bits
    sums = vectors.select("v").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(width)])
    new = [b.copy() for b in books]
    for r in sums.collect():  # as many as the books have entries
        new[r["part"]][r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(width)]
    return new


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id, label, v (array of whole numbers) of the rows whose vector has numbers only."""
    usable = F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cut = F.transform(vec_col, lambda x: F.greatest(F.least(F.floor(x.cast("double") * SCALE), F.lit(1 << 30)), F.lit(-(1 << 30))).cast("int"))
    return materialize(df.where(usable).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), cut.alias("v")), "codes-vectors")


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """id, label, code (binary, one byte for each part), error of each usable row, and the codebooks."""
    vectors = whole_vectors(df, id_col, vec_col, label_col)
    kinds = f"id {vectors.schema['id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}, code binary, error bigint"
    if entries > 256:
        raise ValueError("a code is one byte for each part")
    shortest, longest, largest = vectors.agg(F.min(F.size("v")), F.max(F.size("v")), F.max(F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v"))))).first()
    if shortest is None:
        return df.sparkSession.createDataFrame([], kinds), []
    if shortest != longest or longest % parts:
        raise ValueError(f"vectors of {shortest} to {longest} components can't be cut into {parts} equal parts")
    if (largest or 0) >= LARGEST * SCALE:
        raise ValueError(f"components must be under {LARGEST} in absolute value")
    first = np.array([r["v"] for r in vectors.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()], np.int64)
    books = [x.copy() for x in np.split(first, parts, axis=1)]
    for _ in range(rounds if longest else 0):
        books = refine(vectors, books, largest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, exact=largest >= 1 << 22) for b in books] if longest else []
        for batch in batches:
            codes, error = np.zeros((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            at = 0
            for n, xs in parts_of(batch.column(2), parts) if longest else ():
                for p, x in enumerate(xs):
                    codes[at : at + n, p], far = cells[p].nearest(x)
                    error[at : at + n] += far
                at += n
            code = pa.FixedSizeBinaryArray.from_buffers(pa.binary(parts), len(codes), [None, pa.py_buffer(codes.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code, pa.array(error)], ["id", "label", "code", "error"])

    return materialize(vectors.mapInArrow(run, kinds), "codes"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry, position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """codes with the sum of the errors of all rows with the label. Sums combine before they are shuffled; a table of them
    that is small by count is broadcast, else joined, which the planner can split where a label is frequent."""
    sums = materialize(codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "codes-labels")
    return codes.join(small(sums), F.col("label").eqNullSafe(F.col("__label"))).drop("__label")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(codes).select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds as one common table each."""
    steps = [
        f"k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x)::BIGINT) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT r, vec_id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM k, range({PARTS}) t(p))",
        f"b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, x) - 1 AS e, x AS c FROM x QUALIFY e < {ENTRIES})",
    ]
    for n in range(ROUNDS + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT r, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {ENTRIES} + e) AS best FROM x JOIN b{n} USING (p) GROUP BY 1, 2)")
        if n < ROUNDS:
            steps.append(f"m{n} AS MATERIALIZED (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, best % {ENTRIES} AS e, i, floor(sum(v) / count(*))::BIGINT AS m FROM (SELECT p, best, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{n} JOIN x USING (r, p)) GROUP BY 1, 2, 3) GROUP BY 1, 2)")
            steps.append(f"b{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN m{n} USING (p, e))")
    steps.append(f"o AS (SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code, sum(best // {ENTRIES})::BIGINT AS error FROM a{ROUNDS} GROUP BY 1)")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o JOIN k USING (r), s"


SQL = _sql()
