"""Exact substring dedup with a sparse suffix array, sorted deep-shallow.

A byte goes if a LENGTH-byte string that covers it also starts earlier (smaller doc_id, or the same document further left).

1. Anchors. Of the GRAM-byte hashes inside each LENGTH-byte window the least (leftmost of equals) is the window's anchor. Equal
   windows have equal anchors at equal places inside, so only windows whose anchors have equal hashes can be equal. The
   windows that share an anchor are one context: their text is LENGTH + up to LENGTH - GRAM bytes, and there are about two
   contexts in LENGTH - GRAM + 1 bytes, where there is one window for each byte.
2. Equal contexts (by the anchor's hash and a 64-bit digest of the text and the anchor's place) are one: at the first
   of them nothing is decided yet, all later ones go whole.
3. Where different contexts share an anchor's hash, their suffixes are sorted: multikey quicksort on words of 8 bytes down to
   a shallow depth, all groups side by side; then each group that still has a common prefix by a blind (Patricia) trie.
   Suffixes with a common prefix of LENGTH bytes form a class, of which the earliest stays.

Contexts that copies repeat meet in an aggregate per task first. Anchors that more than CELL contexts share aren't sorted
in one task: their windows are dealt by a digest of their own text instead, and the earliest of each found by an
aggregate. Bit maps, sized by what they have to hold up to MAX_BITS, spare the second pass what surely isn't needed. What they
let through wrongly never changes a result: equal contexts are joined exactly, and a context that is sorted needlessly either
is alone or is a later copy, which goes anyway.

Defined results: a null text is empty; texts under LENGTH bytes lose nothing; rows without doc_id lose nothing and take
nothing from others; rows that repeat a doc_id and a text are one document that stands several times, rows that repeat a
doc_id with another text are documents of their own, in order of the text's hash; ids may be of any type with an order; an empty table returns no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import group_numbers, grouped_batches, materialize, numbered, small, table

LENGTH, GRAM = 100, 32
SHALLOW, CELL = 4, 2048
#: Bits of a map at least and at most (16 MB); between them 16 for each entry.
BITS, MAX_BITS = 1 << 22, 1 << 27
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([b]), 5) for b in range(256)], np.uint64)
_UPPER = np.uint64(0xFFFFFFFF00000000)
_MULTIPLY = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(5)]
KEYS = ["key", "c"]


# --- anchors ----------------------------------------------------------------------------------------------------------


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each context: the anchor's hash (int64) and place, the first and the last window start."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    h, span = _TABLE[np.frombuffer(data, np.uint8)], 1
    for m in _MULTIPLY:  # hashes of 2, 4, ... 32 bytes
        h = h[:-span] * m + h[span:]
        span *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    # the upper half of a hash above its place: the lesser of two numbers is the lesser hash's, or the left one's
    low, span = h & _UPPER | np.arange(len(h), dtype=np.uint64), 1
    width = LENGTH - GRAM + 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: span - width], low[width - span :])
    at = low.astype(np.uint32)
    first = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
    last = np.append(first[1:], len(at)) - 1
    place = at[first].astype(np.int64)
    return h[place].view(np.int64), place, first, last


def contexts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """key, c (digest of the context), lo (first window) and meta (anchor's place and last window, from lo) of each."""
    key, place, lo, hi = anchors(data)
    meta = (place - lo) << 7 | (hi - lo)
    digest = xxhash.xxh3_64_intdigest
    c = [digest(data[a:b], m) for a, b, m in zip(lo.tolist(), (hi + LENGTH).tolist(), meta.tolist(), strict=True)]
    return key, np.array(c, np.uint64).view(np.int64), lo, meta


def _parts(batches: Iterator[pa.RecordBatch], least: int = 40_000) -> Iterator[tuple[list[np.ndarray], list[bytes], np.ndarray]]:
    """key, c, doc, lo, meta of the contexts of some documents at a time, with their texts and each context's text number."""
    held: list[tuple[np.ndarray, ...]] = []
    texts: list[bytes] = []
    n = 0
    for b in batches:
        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            data = text.as_py()
            key, c, lo, meta = contexts(data)
            held.append((key, c, np.full(len(key), doc, np.int64), lo, meta, np.full(len(key), len(texts))))
            texts.append(data)
            n += len(key)
            if n >= least:
                *columns, number = (np.concatenate(x) for x in zip(*held, strict=True))
                yield columns, texts, number
                held, texts, n = [], [], 0
    if n:
        *columns, number = (np.concatenate(x) for x in zip(*held, strict=True))
        yield columns, texts, number


# --- sorting ----------------------------------------------------------------------------------------------------------


def shallow_groups(words: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of rows of words (uint64), those of each given group by themselves: order, and the number of the
    group of equal rows of each in that order. All groups are split at once, each by its own median into less, equal and
    more; what is equal goes on to the next word."""
    n, depth_end = words.shape
    group = np.zeros(n, np.int64) if group is None else group
    order, depth = np.argsort(group, kind="stable"), np.zeros(n, np.int64)
    group = np.cumsum(np.diff(group[order], prepend=group[order[:1]] - 1) != 0) - 1
    done = np.bincount(group)[group] == 1
    while not done.all():
        first = np.flatnonzero(np.diff(group, prepend=-1))
        size = np.diff(np.append(first, n))
        pivot_at = np.repeat(first + size // 2, size)
        key = words[order, np.minimum(depth, depth_end - 1)]
        pivot = key[pivot_at]
        side = np.where(done, 1, 1 + (key > pivot).astype(np.int64) - (key < pivot))
        depth = np.where(done | (side != 1), depth, depth + 1)
        split = group * 3 + side
        again = np.argsort(split, kind="stable")
        order, split, depth = order[again], split[again], depth[again]
        group = np.cumsum(np.diff(split, prepend=split[:1] - 1) != 0) - 1
        size = np.bincount(group)[group]
        done = (size == 1) | (depth >= depth_end)
    return order, group


def blind_sort(values: list[int]) -> list[list[int]]:
    """Indices of the values (numbers of equal width, most significant bit first) in order, equal ones together, by a blind
    trie: the search looks at branching bits only, one comparison with the leaf it reaches gives the true place."""
    leaf: list[list[int]] = [[0]]
    of_leaf = [values[0]]
    root: tuple | list | int = 0  # a leaf's number, or [bit, zero, one]
    for i in range(1, len(values)):
        v, node = values[i], root
        while type(node) is list:
            node = node[1 + (v >> node[0] & 1)]
        differ = of_leaf[node] ^ v
        if not differ:
            leaf[node].append(i)
            continue
        bit = differ.bit_length() - 1
        above, side, node = None, 0, root
        while type(node) is list and node[0] > bit:
            above, side = node, 1 + (v >> node[0] & 1)
            node = node[side]
        leaf.append([i])
        of_leaf.append(v)
        new = [bit, len(leaf) - 1, node] if not v >> bit & 1 else [bit, node, len(leaf) - 1]
        if above is None:
            root = new
        else:
            above[side] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is list:
            stack += [node[2], node[1]]
        else:
            out.append(leaf[node])
    return out


def equal_places(texts: list[bytes], places: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes, of two or more, of equal LENGTH-byte suffix prefixes of the texts: the class's number, text and start of each, class
    by class. places: of the anchor in each text; groups: texts with one anchor's hash. Windows that stand at one distance from
    such anchors are sorted deep-shallow; no others can be equal."""
    length = np.array([len(t) for t in texts])
    size, begin = length - LENGTH + 1, np.cumsum(length) - length
    text = np.repeat(np.arange(len(texts)), size)
    start = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
    at = begin[text] + start
    joined = b"".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    word = np.zeros(len(raw) - 7, np.uint64)  # the 8 bytes from each place on, as a number
    for k in range(8):
        word = word << np.uint64(8) | raw[k : len(raw) - 7 + k]
    order, group = shallow_groups(np.stack([word[at + 8 * k] for k in range(SHALLOW)], axis=1), groups[text] * 128 + places[text] - start)
    many = np.bincount(group)[group] > 1
    order, group = order[many], group[many]
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    where, skip = at[order], 8 * SHALLOW
    # tries of two leaves, side by side
    pair = edges[:-1][np.diff(edges) == 2]
    x, y = where[pair], where[pair + 1]
    for k in [*range(skip, LENGTH - 8, 8), LENGTH - 8]:
        same = word[x + k] == word[y + k]
        pair, x, y = pair[same], x[same], y[same]
    number, row = [np.repeat(pair, 2)], [np.stack([pair, pair + 1], axis=1).ravel()]
    wide, value = np.diff(edges) > 2, int.from_bytes
    names, rows = [], []
    for a, b in zip(edges[:-1][wide].tolist(), edges[1:][wide].tolist(), strict=True):
        for k, same in enumerate(blind_sort([value(joined[x + skip : x + LENGTH]) for x in where[a:b].tolist()])):
            if len(same) > 1:
                names += [a + k] * len(same)
                rows += [a + z for z in same]
    number, row = np.concatenate([*number, np.array(names, np.int64)]), np.concatenate([*row, np.array(rows, np.int64)])
    by_class = np.argsort(number, kind="stable")
    found = order[row[by_class]]
    return number[by_class], text[found], start[found]


def equal_windows(texts: list[bytes], places: np.ndarray, groups: np.ndarray) -> list[list[tuple[int, int]]]:
    """equal_places, as lists of (text, start)."""
    number, text, start = equal_places(texts, places, groups)
    edges = np.flatnonzero(np.diff(number, prepend=-1, append=-1)).tolist()
    both = list(zip(text.tolist(), start.tolist(), strict=True))
    return [both[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def later_runs(number: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, a, b: runs of windows, by document and start, of which an equal one (of the same class's number) stands earlier."""
    order = np.lexsort((at, doc, number))
    number, doc, at = number[order], doc[order], at[order]
    new = np.diff(number, prepend=-1) != 0
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    gone = (doc != doc[first]) | (at != at[first])
    doc, at = doc[gone], at[gone]
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    begin = np.ones(len(doc), bool)
    begin[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)
    begin = np.flatnonzero(begin)
    return doc[begin], at[begin], at[np.append(begin[1:], len(at)) - 1] + 1 if len(at) else at


# --- passes -----------------------------------------------------------------------------------------------------------


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= LENGTH)).select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("binary").alias("text"))


def context_table(rows: DataFrame) -> DataFrame:
    """key, c, doc, lo, meta, n: the first of equal contexts among some documents of a task at a time, and whether there were
    more (n = 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, c, doc, lo, meta), _, _ in _parts(batches):
            order = np.lexsort((lo, doc, c, key))
            key, c, doc, lo, meta = (x[order] for x in (key, c, doc, lo, meta))
            new = np.append(True, (key[1:] != key[:-1]) | (c[1:] != c[:-1]))
            place = np.append(True, new[1:] | (doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1]))
            first = np.flatnonzero(new)
            n = 1 + (np.add.reduceat(place, first, dtype=np.int64) > 1)
            yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (key, c, doc)] + [pa.array(lo[first].astype(np.int32)), pa.array(meta[first].astype(np.int16)), pa.array(n.astype(np.int8))], [*KEYS, "doc", "lo", "meta", "n"])

    return rows.mapInArrow(run, "key bigint, c bigint, doc bigint, lo int, meta smallint, n tinyint")


def bit_map(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """A bit map with a bit set for the hash of each row of a written table."""
    size = min(MAX_BITS, max(BITS, 1 << (16 * rows.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for b in batches:
            bits[_hash(size, *[c.to_numpy() for c in b.columns])] = True
        words = np.packbits(bits, bitorder="little").view("<i8")
        used = np.flatnonzero(words)
        for at in range(0, len(used), 100_000):
            part = used[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(words[part])], ["at", "bits"])

    got = rows.select(*columns).coalesce(16).mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size // 64, np.int64)
    words[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return words.view(np.uint8)


def _hash(size: int, *values: np.ndarray) -> np.ndarray:
    h = np.zeros(len(values[0]), np.uint64)
    for v in values:
        h = (h ^ v.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return (h & np.uint64(size - 1)).astype(np.int64)


def _has(bits: np.ndarray, *values: np.ndarray) -> np.ndarray:
    at = _hash(8 * len(bits), *values)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def second_pass(rows: DataFrame, repeated: np.ndarray, shared: np.ndarray) -> DataFrame:
    """The contexts that may have an equal one (text null), and those first ones whose anchor others may share (with text)."""
    spark = rows.sparkSession
    maps = spark.sparkContext.broadcast((repeated, shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_repeated, in_shared = maps.value
        for columns, texts, number in _parts(batches):
            key, c, doc, lo, meta = columns
            for mask, cut in ((_has(in_repeated, key, c), False), (_has(in_shared, key, c, doc, lo), True)):
                i = np.flatnonzero(mask)
                if len(i):
                    ends = (lo[i] + (meta[i] & 127) + LENGTH).tolist()
                    text = [texts[t][a:b] for t, a, b in zip(number[i].tolist(), lo[i].tolist(), ends, strict=True)] if cut else [None] * len(i)
                    arrays = [pa.array(x[i]) for x in (key, c, doc)] + [pa.array(lo[i].astype(np.int32)), pa.array(meta[i].astype(np.int16)), pa.array(text, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, [*KEYS, "doc", "lo", "meta", "text"])

    return rows.mapInArrow(run, "key bigint, c bigint, doc bigint, lo int, meta smallint, text binary")


def sorted_spans(rows: DataFrame) -> DataFrame:
    """doc, a, b: runs of windows (starts a to b, b left out) that stand earlier, of contexts (key, doc, lo, text) that share
    anchors; at most CELL contexts share one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in grouped_batches(batches, ["key"]):
            text, doc, lo = tab.column("text").to_pylist(), tab.column("doc").to_numpy(), tab.column("lo").to_numpy().astype(np.int64)
            number, place = group_numbers(tab, ["key"]), tab.column("meta").to_numpy().astype(np.int64) >> 7
            edges = np.append(np.flatnonzero(np.diff(number, prepend=-1)), len(number)).tolist()
            first = 0
            for end in edges[1:]:  # some groups at a time, so that memory stays small
                if end - first < 4 * CELL and end != edges[-1]:
                    continue
                same, at, start = equal_places(text[first:end], place[first:end], number[first:end])
                if len(same):
                    runs = later_runs(same, doc[first + at], lo[first + at] + start)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in runs], ["doc", "a", "b"])
                first = end

    return rows.select("key", "doc", "lo", "meta", "text").repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc bigint, a bigint, b bigint")


def hashed_spans(rows: DataFrame) -> DataFrame:
    """As sorted_spans, for anchors that any number of contexts share: windows are dealt by a digest of their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, starts, sums = [], [], []
            for doc, lo, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                for s in range(len(text) - LENGTH + 1):
                    docs.append(doc)
                    starts.append(lo + s)
                    sums.append(xxhash.xxh3_128_digest(text[s : s + LENGTH]))
            d = np.frombuffer(b"".join(sums), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())], ["doc", "a", "d1", "d2"])

    windows = rows.select("doc", "lo", "text").mapInArrow(run, "doc bigint, a bigint, d1 bigint, d2 bigint")
    least = windows.groupBy("d1", "d2").agg(F.min(F.struct("doc", "a")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("d1", "d2", "first")
    return windows.join(least, ["d1", "d2"]).where("doc <> first.doc OR a <> first.a").select("doc", "a", (F.col("a") + 1).alias("b"))


def removed_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, spans: array of (a, b), bytes a to b (b left out) that go; spans may overlap. Documents without any are left out."""
    rows = _rows(docs, id_col, text_col)
    every = context_table(rows).repartition("key")
    one = every.groupBy(*KEYS).agg(F.min(F.struct("doc", "lo", "meta")).alias("first"), F.max("n").alias("n"), F.min(F.struct("doc", "lo")).alias("__x"), F.max(F.struct("doc", "lo")).alias("__y"))
    one = one.select(*KEYS, "first.*", ((F.col("n") > 1) | (F.col("__x") != F.col("__y"))).alias("again"))
    one = one.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("again OR m > 1")
    one = materialize(one, "contexts")
    repeated, shared = one.where("again"), one.where("m > 1")
    found = materialize(second_pass(rows, bit_map(repeated, KEYS), bit_map(shared, [*KEYS, "doc", "lo"])), "contexts-found")
    later = found.where("text IS NULL").join(repeated.select(*KEYS, F.col("doc").alias("__d"), F.col("lo").alias("__l")), KEYS).where("doc <> __d OR lo <> __l")
    spans = later.select("doc", F.col("lo").cast("bigint").alias("a"), (F.col("lo") + F.col("meta").bitwiseAND(F.lit(127).cast("smallint")) + LENGTH).cast("bigint").alias("b"))
    cut = found.where("text IS NOT NULL")
    hot = small(materialize(shared.where(f"m > {CELL}").select("key").distinct(), "contexts-hot"))
    for part in (sorted_spans(cut.join(hot, "key", "left_anti")), hashed_spans(cut.join(hot, "key", "left_semi"))):
        spans = spans.unionByName(part.select("doc", "a", (F.col("b") + LENGTH - 1).alias("b")))
    return spans.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of spans in order; spans that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in runs:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _result(text: Column, spans: Column, with_text: bool) -> Column:
    @F.arrow_udf(RESULT)
    def run(texts: pa.Array, gone: pa.Array) -> pa.Array:
        rows = []
        for t, g in zip(texts, gone, strict=True):
            data, runs = t.as_py() or b"", merged(g.as_py())
            kept = without(data, runs)
            rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in RESULT.split(", ")])

    return run(text.cast("binary"), spans)


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """id and the RESULT columns for each row; kept (the remaining bytes) only with with_text."""
    docs = numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text", "suffixes")
    rows = docs.join(removed_spans(docs, "__doc", "text"), F.col("__doc") == F.col("doc"), "left")
    return rows.select("id", _result(F.col("text"), F.col("spans"), with_text).alias("r")).select("id", "r.*")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(table(spark, sf_dir, "documents"), with_text=False).drop("kept").withColumnRenamed("id", "doc_id")
