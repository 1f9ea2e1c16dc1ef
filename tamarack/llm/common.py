"""Shared parts of the training-data operators: table access, durable cuts of lineage, hashing helpers,
grouped streaming inside a partition, and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows that one comparison cell of a bucket takes; larger buckets are dealt to several cells.
CELL_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as the cluster names it. Only where it is unset
    (tests on one machine) is a temporary one made and put into the session."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{key} isn't set: driver and executors need a folder that they share")
        found = "file://" + tempfile.mkdtemp(prefix="tamarack-shared-")
        spark.conf.set(key, found)
    return found.rstrip("/")


#: The paths that this process gave out, in order.
given_out: list[str] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder. What is written there stays until drop_scratch, as results are read lazily."""
    given_out.append(f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    return given_out[-1]


def drop_scratch(spark: SparkSession, since: int, keep: Iterable[str] = ()) -> None:
    """Deletes what was written under the paths given out since then (a length of given_out), but for some. For a caller who
    has what it needs elsewhere: DataFrames that still read these paths fail afterwards."""
    keep = set(keep)
    for path in [p for p in given_out[since:] if p not in keep]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        given_out.remove(path)


#: Rows of a written table that may be broadcast: some tens of MB where rows are narrow.
BROADCAST_ROWS = 500_000


#: Buckets (keys and a count: some 20 bytes) that may be broadcast.
BUCKET_ROWS = 1_500_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df, a written table, marked to be broadcast if it has at most so many rows; else as it is, and the planner joins by key."""
    return F.broadcast(df) if df.count() <= most else df


def materialize(df: DataFrame, tag: str, columns: list[str] | None = None) -> DataFrame:
    """Cuts lineage: writes df as Parquet in the shared folder and reads it back, so a lost executor costs nothing that
    is already there. Only columns, if given."""
    spark, path = df.sparkSession, scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out.select(*columns) if columns else out


def numbered(docs: DataFrame, id_col: str, text_col: str, tag: str) -> DataFrame:
    """docs with __doc: a whole number in order of (id, text), one for each distinct pair, null for a null id. It's the id itself
    where ids are whole numbers and none stands with two texts, which is found by hashes alone. Otherwise the distinct pairs (by
    128 bits of the text) are sorted and numbered once, written and joined, so that rows that share an id but not a text are
    documents of their own and ids may be of any type that can be ordered."""
    id_type = docs.schema[id_col].dataType
    hashes = [F.xxhash64(text_col), F.xxhash64(F.lit(7), text_col)]
    own = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__i"), hashes[0].alias("__a"), hashes[1].alias("__b"))
    if isinstance(id_type, T.IntegralType):
        # where no id repeats, no text has to be read
        if own.groupBy("__i").count().where("count > 1").isEmpty():
            return docs.withColumn("__doc", F.col(id_col).cast("bigint"))
        ends = own.groupBy("__i").agg(*[f(c).alias(f"{c}{n}") for c in ("__a", "__b") for n, f in enumerate((F.min, F.max))])
        if ends.where("__a0 <> __a1 OR __b0 <> __b1").isEmpty():
            return docs.withColumn("__doc", F.col(id_col).cast("bigint"))
    order = ["__i", "__a", "__b"]
    pairs = own.distinct().repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__doc", F.monotonically_increasing_id())
    pairs = materialize(pairs, f"{tag}-numbers")
    return docs.join(small(pairs), (F.col(id_col) == F.col("__i")) & (hashes[0] == F.col("__a")) & (hashes[1] == F.col("__b")), "left").drop(*order)


def grouped_batches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Re-cuts the batches of a partition sorted by keys so that no group is cut in two. Groups must be of bounded size."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = keys
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in names]
        same = np.ones(batch.num_rows, bool)
        for k, v in zip(names, last, strict=True):
            same &= np.asarray(batch.column(k).to_numpy(zero_copy_only=False)) == v
        cut = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = [batch.slice(cut)]
        else:
            if kept:
                first = kept[-1]
                if any(first.column(k)[first.num_rows - 1].as_py() != v for k, v in zip(names, last, strict=True)):
                    yield pa.Table.from_batches(kept)
                    kept = []
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def group_numbers(tab: pa.Table, keys: list[str]) -> np.ndarray:
    """0, 0, 1, ... for a table sorted by keys."""
    new = np.zeros(tab.num_rows, bool)
    for k in keys:
        v = tab.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.cumsum(new)


class Forest:
    """Union-find over 0..n-1; labels stay resolved between rounds of joins."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray, accept: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
        """Joins the pairs whose ends are still apart; returns those that did join two trees."""
        used, parent, find = self._tree(i, j, accept)
        if used:
            roots = np.arange(len(self.label))
            for x in parent:
                roots[x] = find(x)
            self.label = roots[self.label]
        return [(int(i[k]), int(j[k])) for k in used]

    def needed(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Numbers of the pairs that join would take if all were accepted; nothing is joined."""
        return np.array(self._tree(i, j, None)[0], np.int64)

    def _tree(self, i: np.ndarray, j: np.ndarray, accept: Callable[[int, int], bool] | None) -> tuple[list[int], dict[int, int], Callable[[int], int]]:
        x_of, y_of = self.label[i], self.label[j]
        apart = np.flatnonzero(x_of != y_of)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        used = []
        for k, x, y in zip(apart.tolist(), x_of[apart].tolist(), y_of[apart].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y and (accept is None or accept(int(i[k]), int(j[k]))):
                parent[max(x, y)] = min(x, y)
                used.append(k)
        return used, parent, find


def close_pairs(fp: np.ndarray, group: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs in the same group (sorted) with at most max_bits differing bits, one distance in the order at a time."""
    i, n, step = np.arange(len(fp)), len(fp), 1
    while len(i):
        i = i[i + step < n]
        i = i[group[i + step] == group[i]]
        near = np.bitwise_count(fp[i] ^ fp[i + step]) <= max_bits
        if near.any():
            yield i[near], i[near] + step
        step += 1


def block_masks(n_blocks: int, max_bits: int, bits: int = 64) -> list[int]:
    """Pigeonhole: cut the bits into n_blocks; values that differ in at most max_bits bits agree in n_blocks - max_bits
    blocks at least. One mask, as a signed 64-bit number, for each choice of that many blocks."""
    from itertools import combinations

    edges = [round(k * bits / n_blocks) for k in range(n_blocks + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(blocks, n_blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def deal(rows: DataFrame, keys: list[str], by: str, cell_rows: int, tag: str, sizes: DataFrame | None = None) -> DataFrame:
    """Deals rows to the cells of their buckets (equal keys). Buckets of one row are dropped, as they can't hold a pair. A
    bucket of more than cell_rows is cut into chunks by a hash of the column by, and each pair of chunks is a cell of its own,
    so that no task has to hold a bucket. Returns the columns and __c (cell), sorted by keys and cell in each partition.

    Buckets are counted by an aggregate that combines before it shuffles, unless their sizes (keys and __n) are given; the
    written counts are joined back, which the planner can split where a bucket is large."""
    if sizes is None:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    sizes = materialize(sizes, f"{tag}-buckets")
    rows = rows.join(small(sizes, BUCKET_ROWS), keys)
    chunks = F.ceil(F.col("__n") / cell_rows).cast("long")
    own = F.pmod(F.xxhash64(F.col(by), F.lit(7)), chunks)
    pair = F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda j: F.least(own, j) * chunks + F.greatest(own, j))
    rows = rows.withColumn("__c", F.explode(F.when(F.col("__n") <= cell_rows, F.array(F.lit(0).cast("long"))).otherwise(pair)))
    return rows.drop("__n").repartition(*keys, "__c").sortWithinPartitions(*keys, "__c", by)


def bucket_cells(fps: DataFrame, fp: str, masks: list[int], cell_rows: int = CELL_ROWS, tag: str = "simhash") -> DataFrame:
    """Deals distinct fingerprints (bigint) to comparison cells, once for each mask: the columns and __t, __k, __c (table,
    bucket, cell), sorted by these in each partition."""
    rows = fps.withColumn("__b", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col(fp).bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks)])))
    rows = rows.select(*fps.columns, F.col("__b.t").alias("__t"), F.col("__b.k").alias("__k"))
    return deal(rows, ["__t", "__k"], fp, cell_rows, tag)


def hamming_forest(fps: DataFrame, fp: str, n_blocks: int, max_bits: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links between distinct fingerprints at most max_bits apart: of each cell a spanning forest, so that the rows grow
    with the fingerprints and not with the pairs, while components are those of all links. Columns u, v (bigint)."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tab in grouped_batches(batches, ["__t", "__k", "__c"]):
            v = tab.column(fp).to_numpy()
            group, forest, out = group_numbers(tab, ["__t", "__k", "__c"]), Forest(len(v)), []
            for i, j in close_pairs(v.view(np.uint64), group, max_bits):
                out += forest.join(i, j)
            if out:
                at = np.array(out)
                yield pa.RecordBatch.from_arrays([pa.array(v[at[:, 0]]), pa.array(v[at[:, 1]])], ["u", "v"])

    cells = bucket_cells(fps.select(fp), fp, block_masks(n_blocks, max_bits), cell_rows)
    return cells.mapInArrow(link, "u bigint, v bigint").distinct()


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """Connected components of edges (u, v: one orderable type) by alternating large-star and small-star rounds; returns
    node, root for each node with a link, root being the smallest node. Each round is written to the shared folder; the
    number of rounds grows with the logarithm of the longest path."""
    far, near = F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")
    e = materialize(edges.where("u <> v").select(far, near).distinct(), tag)
    seen = None
    while True:
        n, mark = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if not n or (n, mark) == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = (n, mark)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), tag)


class Memory:
    """A bounded dictionary of two generations: what a slice needs is young; once the young exceed the size, they become
    the old and the old are forgotten. thin() lets go of what came up for the first time, as most strings that are new in a
    slice never come again."""

    #: Flags of what came up before, by hash; cleared once a quarter of them is set.
    FLAGS = 1 << 22

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}
        self.flags, self.set = bytearray(self.FLAGS), 0

    def missing(self, keys: Iterable[str], turn: bool = True) -> list[str]:
        """Makes the known of these keys young; returns the others. turn: the young may become the old before that."""
        if turn and len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        gone = []
        for k in set(keys).difference(young):
            if (v := old.get(k)) is not None:
                young[k] = v
            else:
                gone.append(k)
        return gone

    def add(self, found: dict[str, bytes]) -> None:
        self.young.update(found)

    def thin(self, keys: Iterable[str]) -> None:
        """Of these young keys only those stay that were given here before."""
        if self.set > self.FLAGS // 4:
            self.flags, self.set = bytearray(self.FLAGS), 0
        flags, young, mask = self.flags, self.young, self.FLAGS - 1
        for k in keys:
            if not flags[h := hash(k) & mask]:
                flags[h] = 1
                self.set += 1
                young.pop(k, None)


_turn: dict[str, Callable[[], None]] = {}


def take_turn(name: str, forget: Callable[[], None] | None = None) -> None:
    """Worker processes outlive tasks. What an operator remembers between its tasks is forgotten once another operator takes
    its turn in the process."""
    others = [x for x in _turn if x != name]
    for other in others:
        _turn.pop(other)()
    if others:
        give_back()
    if forget:
        _turn[name] = forget


def give_back() -> None:
    """Returns to the system what Arrow and the C library hold free in this process."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def tidy(name: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, a function of batches, as the operator name: others forget before it, and what a task has freed goes back after it."""

    def outer(batches: Iterator) -> Iterator:
        take_turn(name)
        yield from run(batches)
        give_back()

    return outer


#: Characters that are encoded at a time, so that memory doesn't grow with a batch.
SLICE_CHARS = 2_000_000


def slices(texts: pa.Array) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(x := t.as_py())
        size += len(x or "")
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part
