"""Ranked lexical search by windowed bucket scoring.

Documents are cut into terms once; of each stay its length and its postings for the terms that any query has (term number,
occurrences), written to the shared folder. Counts (documents, all terms, documents of each term) are aggregates of that table.

Scoring shuffles no postings: each partition of the written table is a segment whose documents, in order of their id, have
dense numbers. It's traversed in windows of WINDOW numbers (less where documents are long: POSTINGS). In a window the postings
are turned to term order, and for each query those of its terms are scatter-added into an array with one bucket for each
document. A bitset of each term marks the buckets that it touches; their union for a query says which to harvest and to clear.
What is over the lowest of the query's heap goes into the heap, of TOP documents for each query and segment. The heaps of
all segments are merged by rank. No key is dealt out before that, so none can be hot.

Queries are the distinct texts of the query table, in blocks of about BLOCK_CHARS characters: one block's terms are held by the
driver and sent to the workers, and documents are read once for each block.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.

Defined results: a null or empty document has no terms and isn't counted; a null or empty query finds nothing; a null doc_id is
ranked before others of its score; rows that repeat a doc_id are documents of their own; query rows that repeat an id or a text
each return rows; equal scores are in order of doc_id; empty tables return no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table
from .token_files import byte_slices, bytes_of

#: Buckets of a window, postings after which a window ends early, bytes of text that are cut at a time.
WINDOW, POSTINGS, SLICE = 4096, 2_000_000, 8_000_000
#: Characters of the queries of a block: its distinct terms are fewer by far.
BLOCK_CHARS = 16_000_000
_IN_TERM = np.array([b > 127 or chr(b).isalnum() for b in range(256)])
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def terms_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Of an array of texts: the distinct terms, the number of each term in them in text order, and the terms of each text."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]].tobytes()
    offsets -= offsets[0]
    data = np.frombuffer(raw.translate(_LOWER), np.uint8)
    inside = _IN_TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = inside[first]  # no term crosses a text's border
    starts = np.flatnonzero(begins)
    before = np.append(0, np.cumsum(inside))  # of the bytes of terms alone
    edges = np.append(before[starts], before[-1]).astype(np.int32)
    every = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data[inside].tobytes())]).dictionary_encode()
    return bytes_of(every.dictionary), every.indices.to_numpy(), np.diff(np.searchsorted(starts, offsets))


def query_terms(text: str) -> dict[bytes, int]:
    words, numbers, _ = terms_of(pa.array([text]))
    return {words[k]: n for k, n in Counter(numbers.tolist()).items()}


def postings(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """id, n (terms), terms and tfs (arrays: numbers in the vocabulary in order, occurrences) of each row with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(sent.value)}
        for b in batches:
            for part in byte_slices(b, 1, SLICE):
                words, at, n = terms_of(part.column(1))
                known = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))[at]
                row = np.repeat(np.arange(len(n)), n)[known >= 0]
                key, tf = np.unique(row * len(number) + known[known >= 0], return_counts=True) if len(number) else (np.empty(0, np.int64),) * 2
                row = key // max(1, len(number))
                ends = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key - row * len(number), tf)]
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *lists], ["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n bigint, terms array<int>, tfs array<int>")


def term_documents(index: DataFrame, n_terms: int) -> np.ndarray:
    """How many rows of the index each term stands in; one row for each term and partition is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in index.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    return df


class Heap:
    """The top documents of a query in one segment: (score, minus the document's number, id)."""

    def __init__(self, top: int):
        self.top, self.held = top, []

    def harvest(self, scores: np.ndarray, numbers: np.ndarray, ids: pa.Array, first: int) -> None:
        """Takes in documents of a window, in order of their number, which starts at first."""
        floor = self.held[0][0] if len(self.held) == self.top else 0
        over = np.flatnonzero(scores > floor)
        if len(over) > self.top:  # the best of the window, of equal ones the first
            least = np.partition(scores[over], -self.top)[-self.top]
            more, same = over[scores[over] > least], over[scores[over] == least]
            over = np.sort(np.concatenate([more, same[: self.top - len(more)]]))
        for k in over.tolist():
            at = int(numbers[k])
            entry = (int(scores[k]), -(first + at), ids[at].as_py())
            if len(self.held) < self.top:
                heapq.heappush(self.held, entry)
            elif entry[:2] > self.held[0][:2]:
                heapq.heapreplace(self.held, entry)


def windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches of up to WINDOW rows and of up to most postings, but for a row that has more."""
    for b in batches:
        ends = np.append(0, np.cumsum(pc.list_value_length(b.column(2)).to_numpy()))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(ends, ends[at] + most, "right")) - 1
            to = min(max(to, at + 1), at + WINDOW, b.num_rows)
            yield b.slice(at, to - at)
            at = to


def score(index: DataFrame, queries: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """query (its place in the list), id, score: of each segment the top documents of each query."""
    sent = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = sent.value
        heaps, done = [Heap(top) for _ in asked], 0
        sums = np.zeros(WINDOW, np.int64)
        for b in windows(batches, POSTINGS):
            ids, size = b.column(0), pc.list_value_length(b.column(2)).to_numpy()
            terms, tf = (b.column(k).flatten().to_numpy() for k in (2, 3))
            length = 25 + 75 * b.column(1).to_numpy() * n_docs // n_terms
            order = np.argsort(terms, kind="stable")
            bucket, terms, tf = np.repeat(np.arange(b.num_rows), size)[order], terms[order], tf[order].astype(np.int64)
            part = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * length[bucket]))
            here, begin = np.unique(terms, return_index=True)
            place = dict(zip(here.tolist(), zip(begin.tolist(), [*begin[1:].tolist(), len(terms)]), strict=True))
            marks: dict[int, np.ndarray] = {}
            for heap, query in zip(heaps, asked, strict=True):
                occupied = None
                for t, times in query.items():
                    if (span := place.get(t)) is None:
                        continue
                    at = slice(*span)
                    sums[bucket[at]] += part[at] * times
                    if (mark := marks.get(t)) is None:
                        flags = np.zeros(WINDOW, bool)
                        flags[bucket[at]] = True
                        mark = marks[t] = np.packbits(flags)
                    occupied = mark if occupied is None else occupied | mark
                if occupied is not None:
                    at = np.flatnonzero(np.unpackbits(occupied))
                    heap.harvest(sums[at], at, ids, done)
                    sums[at] = 0
            done += b.num_rows
        rows = [(k, i, s) for k, heap in enumerate(heaps) for s, _, i in heap.held]
        if rows:
            q, i, s = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, id_type), pa.array(s, pa.int64())], ["query", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(index.schema["id"].dataType)
    return index.sortWithinPartitions("id").mapInArrow(run, f"query int, id {index.schema['id'].dataType.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item, rank (from 1), id, score: of each query row the top documents with a score over 0."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item"), F.sha2(item_text, 256).alias("__q"), F.col(item_text).alias("__text")).where("__text IS NOT NULL")
    texts = materialize(asked.select("__q", "__text").distinct(), "search-queries")
    blocks = max(1, math.ceil((texts.agg(F.sum(F.length("__text"))).first()[0] or 0) / block_chars))
    id_kind, out = docs.schema[id_col].dataType.simpleString(), None
    for k in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("__q"), F.lit(blocks)) == k).orderBy("__q").collect()
        found = [query_terms(r["__text"]) for r in rows]
        vocabulary = sorted({t for q in found for t in q})
        number = {t: i for i, t in enumerate(vocabulary)}
        index = materialize(postings(docs, vocabulary, id_col, text_col), "search-postings")
        n_docs, n_terms = index.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs or not vocabulary:
            continue
        df = term_documents(index, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        scored = score(index, [{number[t]: n for t, n in q.items()} for q in found], weights, n_docs, n_terms, top)
        keys = spark.createDataFrame([(i, r["__q"]) for i, r in enumerate(rows)], "query int, __q string")
        scored = scored.join(F.broadcast(keys), "query").drop("query")  # as many rows as a block has queries
        out = scored if out is None else out.unionByName(scored)
    if out is None:
        out = spark.createDataFrame([], f"id {id_kind}, score bigint, __q string")
    rank = F.row_number().over(Window.partitionBy("__q").orderBy(F.desc("score"), F.asc("id")))
    best = materialize(out.withColumn("rank", rank).where(F.col("rank") <= top), "search-ranks")
    return asked.drop("__text").join(best, "__q").select("item", "rank", "id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


_TERMS = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
SQL = f"""WITH t AS (SELECT doc_id, {_TERMS} FROM documents), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1), s AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM n),
  q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} FROM benchmark) GROUP BY 1, 2),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
  w AS (SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), s),
  f AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::BIGINT AS score FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), s GROUP BY 1, 2)
  SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0) WHERE rank <= 10"""
