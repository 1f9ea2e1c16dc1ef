"""SimHash near-duplicates: 64-bit fingerprints over three-word shingles, pigeonhole blocks, verified Hamming distance.

Fingerprints at most max_bits apart agree in n_blocks - max_bits of n_blocks blocks at least, so a bucket for each choice
of that many blocks holds every close pair. Six blocks give 20 buckets of about 32 bits: random fingerprints rarely meet,
which keeps the comparisons in proportion to true neighbours at any corpus size this key space fits. Equal fingerprints
are one node, so copies never form pairs; large buckets are cut into cells (see common.deal).

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any other; a null
doc_id takes part, but is never a component's name (a component of null ids only has a null name); repeated rows each
return a row; an empty table returns no rows; other columns are ignored by `near_groups` and kept by `dedup`.

`similar_groups` links by shingles instead of bits: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or
more. Fingerprints that differ as much as those of such texts (about 10 of 64 bits) don't agree in blocks of their bits, so the
blocks are SimHashes of classes of shingles (see blocks); candidates are verified by their sets, as 32-bit hashes. There, texts
of equal words (also of none) are one; texts of fewer than five shingles have equal ones only; rows without id take no part
and stay; of rows that repeat an id with other words, the text that is found first stands for the id in the comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import blocks
from .common import CELL_ROWS, components, hamming_forest, materialize, small, table, tidy

SEED, SHINGLE, MAX_BITS, N_BLOCKS = 42, 3, 3, 6
_LANES = np.uint64(0x0101010101010101)


def majority(h: np.ndarray) -> int:
    """The 64-bit number whose bits are set in over half of h (uint64)."""
    counts = np.zeros(64, np.int64)
    full = np.concatenate([h, np.zeros(-len(h) % 255, np.uint64)])
    for k in range(8):
        lanes = ((full >> np.uint64(k)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[k::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None) -> int:
    """SimHash of UTF-8 bytes: A-Z lower-cased, words between ASCII white space, XXH64 of each shingle of three words."""
    words = (text or b"").lower().split()
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip([0, *(e + 1 for e in ends)], ends[SHINGLE - 1 :], strict=False)])
    return majority(np.frombuffer(hashes, ">u8").astype(np.uint64))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp (bigint with the fingerprint's bits) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_signed(fingerprint(t.as_py())) for t in b.column(1)], pa.int64())], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(tidy("simhash", run), f"id {kind}, fp bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, n_blocks: int = N_BLOCKS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """id, fp, component_id: the smallest id reachable over links of at most max_bits differing bits."""
    rows = materialize(with_fingerprint(docs, id_col, text_col), "simhash")
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-nodes")
    roots = components(hamming_forest(nodes, "fp", n_blocks, max_bits, cell_rows), "simhash-links")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    names = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(names, "root").select("fp", "component_id")
    return rows.join(nodes, "fp").join(named, "fp", "left").select("id", "fp", F.coalesce("component_id", "rep").alias("component_id"))


# --- by shingles ------------------------------------------------------------------------------------------------------

#: Words of a shingle, least Jaccard similarity; blocks and bits of the candidates, and rows of their cells.
WIDE, SIMILARITY, WIDE_BLOCKS, WIDE_BITS, WIDE_CELL = 5, 0.8, 8, 20, 256
#: Bytes of text that are fingerprinted at a time (a longer text is taken whole).
SLICE = 1_000_000
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_OWNER_BITS = np.uint64(20)


def shingle_sets(texts: list[bytes], size: int = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of one text after the other, as numbers (uint64) in order within each, and how many each text has.
    A text of fewer words has one shingle, all its words."""
    joined = b"\n".join([*texts, b""]).translate(_LOWER)
    data = np.frombuffer(joined, np.uint8)
    start, _, h = blocks.word_hashes(data, _BLANK[data])
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    n = np.bincount(owner, minlength=len(texts))
    base, mix = np.uint64(0x9E3779B97F4A7C15), np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        mix = mix * base + h[k : k + len(mix)]
    whole = owner[: len(mix)] == owner[size - 1 :] if len(mix) else np.zeros(0, bool)
    shingles, of = mix[whole], owner[: len(mix)][whole]
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        at = np.cumsum(n) - n
        extra = np.array([xxhash.xxh64_intdigest(h[at[i] : at[i] + n[i]].tobytes(), int(n[i])) for i in few.tolist()], np.uint64)
        shingles, of = np.concatenate([shingles, extra]), np.concatenate([of, few])
    # the owner above, 44 bits of the shingle below: one sort of numbers
    keyed = np.unique(of.astype(np.uint64) << (np.uint64(64) - _OWNER_BITS) | blocks.mixed(shingles) >> _OWNER_BITS)
    sizes = np.bincount((keyed >> (np.uint64(64) - _OWNER_BITS)).astype(np.int64), minlength=len(texts))
    return keyed & np.uint64((1 << 44) - 1), sizes


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, held = [], [], 0
    for b in batches:
        for i in range(b.num_rows):
            ids.append(b.column(0)[i].as_py())
            texts.append(b.column(1)[i].as_py())
            held += len(texts[-1])
            if held >= SLICE or len(ids) >> int(_OWNER_BITS):
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _name(text: bytes) -> bytes:
    """128-bit digest of a text's words."""
    return xxhash.xxh3_128_digest(b" ".join(text.translate(_LOWER).split()))


def _wide(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, node, fp, keys of each row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _sliced(batches):
            shingles, sizes = shingle_sets(texts)
            h, some = blocks.mixed(shingles), sizes > 0
            owners, keys = blocks.keys_of(h, sizes, 900, WIDE_BLOCKS)
            fp = np.zeros(len(ids), np.uint64)
            fp[some] = blocks.majority(h, (np.cumsum(sizes) - sizes)[some], sizes[some])
            ends = np.append(0, np.cumsum(np.bincount(owners, minlength=len(ids))))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind_of), pa.array([_name(t) for t in texts], pa.binary()), pa.array(fp.view(np.int64)), lists], ["id", "node", "fp", "keys"])

    kind = docs.schema[id_col].dataType
    kind_of = to_arrow_type(kind)
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(tidy("simhash", run), f"id {kind.simpleString()}, node binary, fp bigint, keys array<bigint>")


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, value (the shingles as sorted 32-bit numbers) of wanted (id, node)."""
    rows = blocks.of_documents(docs, wanted, "node", id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, nodes in zip(b.column(0), b.column(1), strict=True):
                text = text.as_py()
                name = _name(text)
                if name in nodes.as_py():
                    value = np.unique(shingle_sets([text])[0].astype(np.uint32)).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([value], pa.binary())], ["node", "value"])

    found = rows.select(F.col("text").cast("binary"), "wanted").mapInArrow(tidy("simhash", run), "node binary, value binary")
    return found.dropDuplicates(["node"])


def jaccard(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted sets have at least this similarity."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def _jaccards(values: pa.ChunkedArray, least: float):
    """A function of index pairs and the differing bits of their fingerprints: whether the sets are similar."""
    sets: dict[int, np.ndarray] = {}

    def get(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = np.frombuffer(values[k].as_py(), np.uint32)
        return sets[k]

    def decide(i: np.ndarray, j: np.ndarray, bits: np.ndarray) -> np.ndarray:
        return np.array([jaccard(get(x), get(y), least) for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)

    return decide


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, cell_rows: int = WIDE_CELL) -> DataFrame:
    """id, component_id of each row with an id: the smallest id reachable over links of at least this similarity."""
    rows = materialize(_wide(docs, id_col, text_col), "shingles")
    nodes = materialize(rows.groupBy("node").agg(F.min("id").alias("rep"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "shingle-nodes")
    near = blocks.partners(nodes.select("node", "fp", "keys"), WIDE_BITS, cell_rows, "shingles")
    wanted = nodes.join(near.select("node"), "node", "left_semi").select(F.col("rep").alias("id"), "node")
    sets = _sets_of(docs, wanted, id_col, text_col).join(near, "node")
    links = blocks.verified_links(sets, WIDE_BITS, "binary", lambda values: _jaccards(values, least))
    roots = components(links, "shingle-links")
    linked = nodes.select("node", "rep").join(roots, "node")
    names = linked.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = linked.join(names, "root").select("node", "component_id")
    own = materialize(nodes.select("node", "rep").join(named, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id")), "shingle-names")
    return rows.select("id", "node").join(own, "node").select("id", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups=similar_groups, **params) -> DataFrame:
    """docs with the row of the smallest id of each group, by shingles or (groups=near_groups) by bits. Rows that repeat that id
    all stay; rows without an id stay."""
    gone = groups(docs, id_col, text_col, **params).where("id <> component_id").select(F.col("id").alias(id_col)).distinct()
    return docs.join(small(materialize(gone, "simhash-gone")), id_col, "left_anti").select(*docs.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
