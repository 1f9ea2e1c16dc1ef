"""Byte-level BPE encoding and decoding by merge ranks, with a bucketed rank queue.

The queue holds, for each merge rank, the linked-list positions whose pair has that rank; a hierarchical bitmap over the
ranks finds the lowest rank with a position in a few word operations. Each merge costs a constant number of steps
whatever the length of the pre-token, where rescanning the pairs costs their number. Entries that an earlier merge made
stale are recognised when they are taken out (the pair at that position no longer has that rank) and skipped. Many
pre-tokens lie in one buffer, as no pair spans a border: ranks only order merges within a pre-token, so the first positions that a
rank has in each of them are merged at once, as arrays.

Text is cut at single spaces between other characters first; such a space always starts a token of the pattern, so the
pieces can be encoded apart and remembered. The memory of pieces is bounded (CACHE entries for each worker) and only
saves time.

Defined results: a null or empty text has no ids and decodes to no bytes; texts of any length are encoded whole; an id
outside the vocabulary raises KeyError on decoding; repeated rows each return a row; an empty table returns no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memory, slices, table, take_turn

CACHE = 200_000
#: \s as Unicode's White_Space, which the pattern means.
_MARKS = frozenset(".,;:!?")
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: Positions of a rank that are merged at once, at least.
MANY = 100
#: Positions for each pre-token, on average, from which they are merged one by one.
SHARE = 8


class PairTable:
    """Ranks of pairs of token numbers, many at a time: open addressing in arrays."""

    def __init__(self, left: list[int], right: list[int], rank: list[int]):
        key = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        size = max(10, (4 * len(key)).bit_length())
        self.shift, self.mask, self.none = np.uint64(64 - size), (1 << size) - 1, ~np.uint64(0)
        self.key, self.rank = np.full(1 << size, self.none, np.uint64), np.full(1 << size, -1, np.int32)
        rest, at, rank = np.arange(len(key)), self._slot(key), np.array(rank, np.int32)
        while len(rest):
            free = rest[self.key[at[rest]] == self.none]
            _, first = np.unique(at[free], return_index=True)
            here = free[first]
            self.key[at[here]], self.rank[at[here]] = key[here], rank[here]
            rest = rest[self.key[at[rest]] != key[rest]]
            at[rest] = at[rest] + 1 & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        """The rank of each pair, -1 where there is none."""
        key = (np.asarray(left).astype(np.uint64) << np.uint64(32)) | np.asarray(right).astype(np.uint64)
        at = self._slot(key)
        found, out = self.key[at], self.rank[at]
        rest = np.flatnonzero((found != key) & (found != self.none))
        while len(rest):
            at[rest] = at[rest] + 1 & self.mask
            found, out[rest] = self.key[at[rest]], self.rank[at[rest]]
            rest = rest[(found != key[rest]) & (found != self.none)]
        return out


class RankQueue:
    """Positions in buckets by rank. Three levels of 64-bit words mark which buckets hold any."""

    def __init__(self, n_ranks: int):
        self.bucket: list[list[int] | None] = [None] * n_ranks
        self.low = [0] * (n_ranks // 64 + 1)
        self.mid = [0] * (n_ranks // 4096 + 1)
        self.top = 0  # one bit for each word of mid, as wide as the ranks need

    def put(self, rank: int, at: int) -> None:
        held = self.bucket[rank]
        if held:
            held.append(at)
            return
        self.bucket[rank] = [at]
        word = rank >> 6
        if not self.low[word]:
            self.mid[word >> 6] |= 1 << (word & 63)
            self.top |= 1 << (word >> 6)
        self.low[word] |= 1 << (rank & 63)

    def fill(self, rank: int, places: list[int]) -> None:
        """Puts places into an empty bucket."""
        self.put(rank, 0)
        self.bucket[rank] = places

    def take(self) -> tuple[int, list[int]] | None:
        """The lowest rank with positions and all of them, which leave the queue."""
        if not self.top:
            return None
        m = (self.top & -self.top).bit_length() - 1
        x = self.mid[m]
        word = (m << 6) + (x & -x).bit_length() - 1
        x = self.low[word]
        rank = (word << 6) + (x & -x).bit_length() - 1
        self.low[word] = x & (x - 1)
        if not self.low[word]:
            self.mid[m] &= ~(1 << (word & 63))
            if not self.mid[m]:
                self.top &= ~(1 << m)
        held, self.bucket[rank] = self.bucket[rank], None
        return rank, held


class Coder:
    """Encodes and decodes by the ranks of a rank file; pattern cuts pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_size: int = CACHE):
        self.ranks = ranks
        space = f"[{_SPACE}]"
        exact = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", space)
        self.cut = regex.compile(exact).findall
        self.spaces = [c for c in map(chr, range(0x3001)) if regex.fullmatch(space, c)]
        self.spaced = regex.compile(f"(?<![{_SPACE}]) (?![{_SPACE}])").split
        n_ranks = max(ranks.values(), default=0) + 1
        self.queue, self.n_ranks = RankQueue(n_ranks), n_ranks
        self.tokens: list[bytes | None] = [None] * n_ranks
        for t, r in ranks.items():
            self.tokens[r] = t
        number = {bytes([b]): n_ranks + b for b in range(256)} | ranks  # a byte that is no token has a number beyond them
        self.of_byte = np.array([number[bytes([b])] for b in range(256)], np.int32)
        get = number.get
        pairs = [(x, y, r) for t, r in ranks.items() for k in range(1, len(t)) if (x := get(t[:k])) is not None and (y := get(t[k:])) is not None]
        self.pairs = PairTable(*map(list, zip(*pairs, strict=True))) if pairs else PairTable([], [], [])
        self.pair_rank = np.full(1 << 16, -1, np.int32)
        for t, r in ranks.items():
            if len(t) == 2:
                self.pair_rank[t[0] << 8 | t[1]] = r
        # chunks and pre-tokens in one: a pre-token alone is cut as one pre-token, so either way a string has the same ids
        self.known = Memory(cache_size)

    def odd(self, text: str) -> bool:
        """Whether a space stands beside another character of \\s."""
        return any(c in text and (f" {c}" in text or f"{c} " in text) for c in self.spaces)

    def merge(self, tokens: list[bytes]) -> list[bytes]:
        """The ids of each pre-token, as little-endian unsigned 32-bit numbers. Of the positions of a rank the first in each
        pre-token are merged at once if there are many, the others one by one."""
        if not tokens:
            return []
        get, put, bucket, fill = self.ranks.get, self.queue.put, self.queue.bucket, self.queue.fill
        buf = b"".join(tokens)
        n = len(buf)
        size = np.array([*map(len, tokens)])
        starts = np.append(0, np.cumsum(size))
        # a linked list of the parts, by first byte; each part's token and the rank of the pair that it begins
        afters, befores = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        first = np.frombuffer(buf, np.uint8)
        parts = np.append(self.of_byte[first], np.int32(0))
        borders = np.zeros(n + 1, bool)  # a pre-token starts here
        borders[starts] = True
        ranks = np.full(n + 1, -1, np.int32)
        ranks[: n - 1] = self.pair_rank[first[:-1].astype(np.intp) << 8 | first[1:]]
        ranks[:-1][borders[1:]] = -1
        owner, lives = np.repeat(np.arange(len(tokens), dtype=np.int32), size), np.ones(n, bool)
        after, before, part, rank_of, alive, border = (memoryview(x) for x in (afters, befores, parts, ranks, lives.view(np.uint8), borders.view(np.uint8)))

        def deal(at: np.ndarray, to: np.ndarray) -> None:
            order = np.argsort(to, kind="stable")
            at, to = at[order], to[order]
            edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1)).tolist()
            at, keys = at.tolist(), to[edges[:-1]].tolist()
            for r, x, y in zip(keys, edges, edges[1:], strict=False):
                if held := bucket[r]:
                    held += at[x:y]
                else:
                    fill(r, at[x:y])

        def ahead(rank: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Merges the first of the positions in each pre-token; returns the others and those that wait."""
            of = owner[at]
            new = np.ones(len(at), bool)
            new[1:] = of[1:] != of[:-1]
            i, rest = at[new], at[~new]
            j = afters[i]
            end = afters[j]
            lives[j], ranks[j], afters[i], befores[end], parts[i] = False, -1, end, i, rank
            right = np.where(borders[end], -1, self.pairs.get(rank, parts[end]))
            ranks[i] = right
            inner = np.flatnonzero(~borders[i])
            h = befores[i[inner]]
            left = self.pairs.get(parts[h], rank)
            ranks[h] = left
            deal(np.concatenate([i[right >= 0], h[left >= 0]]), np.concatenate([right[right >= 0], left[left >= 0]]))
            # a lower rank comes first in its pre-token, whose other places wait
            low = (right >= 0) & (right < rank)
            low[inner] |= (left >= 0) & (left < rank)
            if not low.any():
                return rest, rest[:0]
            waits = np.isin(of[~new], of[new][low])
            return rest[~waits], rest[waits]

        whole = np.flatnonzero(ranks >= 0)
        deal(whole, ranks[whole])
        while (taken := self.queue.take()) is not None:
            rank, places = taken
            if len(places) < MANY:
                places.sort()
            else:
                at = np.sort(np.array(places))
                while len(at := at[ranks[at] == rank]) >= MANY:  # the others are stale
                    of = owner[at]
                    if SHARE * (1 + np.count_nonzero(of[1:] != of[:-1])) < len(at):
                        break  # few pre-tokens hold them
                    at, waits = ahead(rank, at)
                    for k in waits.tolist():
                        put(rank, k)
                places = at.tolist()
            wait = 0
            for i in places:
                if rank_of[i] != rank:
                    continue  # stale
                if i < wait:
                    put(rank, i)
                    continue
                j = after[i]
                end = after[j]
                alive[j], rank_of[j], after[i], before[end], part[i] = 0, -1, end, i, rank
                lower = False
                if border[end] or (r := get(buf[i : after[end]])) is None:
                    rank_of[i] = -1
                else:
                    rank_of[i] = r
                    if held := bucket[r]:
                        held.append(i)
                    else:
                        put(r, i)
                    lower = r < rank
                if not border[i]:
                    h = before[i]
                    if (r := get(buf[h:end])) is None:
                        rank_of[h] = -1
                    else:
                        rank_of[h] = r
                        if held := bucket[r]:
                            held.append(h)
                        else:
                            put(r, h)
                        lower = lower or r < rank
                if lower:  # it comes first in this pre-token, whose other places wait
                    wait = int(starts[owner[i] + 1])
        ids = parts[:n][lives]
        if ids.max() >= self.n_ranks:
            raise KeyError(bytes([int(ids.max()) - self.n_ranks]))
        raw, edges = ids.astype("<u4").tobytes(), (4 * np.append(0, np.cumsum(lives))[starts]).tolist()
        return [raw[x:y] for x, y in zip(edges, edges[1:], strict=False)]

    def learn(self, chunks: list[str]) -> set[str]:
        """Remembers the ids of each chunk and of its pre-tokens; those that aren't known are merged in one buffer. Returns all
        strings that are new in the memory."""
        ranks, known = self.ranks, self.known
        # a space and letters are one pre-token; a mark after them is another
        cut = [[c] if (w := c[1:]).isalpha() and c[0] == " " else [c[:-1], c[-1]] if w[-1:] in _MARKS and w[:-1].isalpha() and c[0] == " " else self.cut(c) for c in chunks]
        new = {p: p.encode() for p in known.missing({p for parts in cut for p in parts}, turn=False)}
        rest = [p for p, b in new.items() if b not in ranks]
        known.add({p: ranks[b].to_bytes(4, "little") for p, b in new.items() if b in ranks})
        known.add(dict(zip(rest, self.merge([new[p] for p in rest]), strict=True)))
        get = known.young.__getitem__
        known.add({c: b"".join(map(get, parts)) for c, parts in zip(chunks, cut, strict=True) if len(parts) != 1})
        return {*chunks, *new}

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit numbers."""
        split = []
        for t in texts:
            t = t or ""
            # the first chunk has no space before it; a text that starts with one has an empty first part
            if "\0" in t or self.odd(t):
                parts = self.spaced(t)
                split.append([parts[0], *[" " + p for p in parts[1:]]])
            else:
                split.append(t.replace(" ", "\0 ").split("\0"))
        known = self.known
        new = self.learn(known.missing(set().union(*split)))
        get = known.young.__getitem__
        out = [b"".join(map(get, s)) for s in split]
        known.thin(new)
        return out

    def forget(self) -> None:
        self.known = Memory(self.known.size)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<u4").tolist()

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids (little-endian unsigned 32-bit) stand for."""
        try:
            return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        except (IndexError, TypeError):
            raise KeyError("an id outside the vocabulary") from None


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


@cache
def coder(path: str, pattern: str) -> Coder:
    """One coder for each worker process, its memory of pieces kept between batches and tasks."""
    with open(path, "rb") as f:
        return Coder(read_ranks(f.read()), pattern)


def _public(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def _coder(path: str | None, pattern: str | None) -> Coder:
    c = coder(*_public(path, pattern))
    take_turn("bpe", c.forget)
    return c


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id, n_tokens, ids (binary: little-endian unsigned 32-bit numbers) for each row. path is a rank file that every
    worker can open, such as one that an installed package has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _coder(path, pattern)
        for b in batches:
            at = 0
            for part in slices(b.column(1)):
                ids = c.encode_batch(part)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])
                at += len(part)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """encoded with the column decoded (binary)."""

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        c = _coder(path, pattern)
        return pa.array([c.decode(x.as_py()) for x in ids], pa.binary())

    return encoded.withColumn("decoded", run("ids"))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """id, n_tokens and the SHA-256 of the ids and of the decoded bytes, one pass, nothing wide leaving the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, sha = _coder(path, pattern), lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            ids = (x for part in slices(b.column(1)) for x in c.encode_batch(part))
            rows = [(len(x) // 4, sha(x), sha(c.decode(x))) for x in ids]
            n, i, d = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
