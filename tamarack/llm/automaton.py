"""BPE by a tokenization automaton: merges are compiled into a deterministic automaton over tokens, words are encoded by
its transitions, ids are decoded by emitting arc labels.

The automaton accepts exactly the token sequences that the merges give for some word. It starts as one state with an arc to
itself for each base symbol. Each merge (u, v), in order, is one gadget: the state that arcs labelled u lead to is split into
a copy without its arc v, every arc u is led to the copy, and wherever u then v could be read an arc uv is laid to where v led.
All arcs of one label lead to one state throughout, so a state is no more than the set of labels that may follow.

These sets aren't written out (states times tokens). Tokens are numbered in preorder of the forest of left operands, newest
child first. Taking away v takes with it the tokens that later merges will lay beside it, those that begin with v and don't
exist yet; in that order they are one interval. A state is hence the sorted bounds of the intervals that it lacks.

A word is encoded from left to right: every prefix has one accepted sequence, so one state. From each position the trie of the
tokens' symbols is followed; a token ends a step if the position's state has its arc. The steps grow with the word's length
times that of the longest token, whatever the word.

Defined results: a null or empty text has no ids and decodes to an empty text; texts and words of any length are encoded
whole; added tokens that stand in a text get their ids, as the library does it; on decoding, ids outside the vocabulary are
left out; repeated rows each return a row; an empty table returns no rows; other columns are ignored. A tokenizer whose model
isn't byte-level BPE with distinct merged tokens (or has dropout, unknown tokens, byte fallback, truncation, padding, a
post-processor that cuts, or a decoder) raises ValueError.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .token_files import _BYTE_LETTERS, _KNOWN, _PIECE, SLICE, WordEncoder, byte_slices

_BYTE_OF = {chr(_BYTE_LETTERS.get(b, b)): b for b in range(256)}
#: Symbols of words: a byte, or with LAST the byte that ends a word.
LAST, BITS = 256, 9


class Automaton:
    """States and arcs for merges in order. base: id of each base symbol (a tuple of one); merges: (left id, right id, id)."""

    def __init__(self, base: dict[int, int], merges: list[tuple[int, int, int]]):
        if len({w for _, _, w in merges} | set(base.values())) != len(merges) + len(base):
            raise ValueError("two merges give one token")
        size = dict.fromkeys(base.values(), 1) | {w: 1 for _, _, w in merges}
        for u, _, w in reversed(merges):
            size[u] += size[w]
        self.order: dict[int, int] = {}  # preorder number of each token
        free: dict[int, int] = {}  # up to where the tokens under it aren't laid yet
        at = 0
        for t in base.values():
            self.order[t], at = at, at + size[t]
            free[t] = at
        start: list[int] = []  # the bounds of what a state lacks: the start lacks nothing
        self.start, self.target = start, {t: start for t in base.values()}
        self.spelling = {t: (s,) for s, t in base.items()}
        for u, v, w in merges:
            at, q, r = self.order[v], self.target.get(u), self.target.get(v)
            if q is not None and r is not None and not (i := bisect_right(q, at)) & 1:
                self.target[u] = [*q[:i], at, free[v], *q[i:]]
                self.target[w] = r
                self.spelling[w] = self.spelling[u] + self.spelling[v]
            # else u is never followed by v any more: no word has this token
            free[u] -= size[w]
            self.order[w], free[w] = free[u], free[u] + size[w]
        self.step: dict[int, int] = {}  # (node, symbol) to node
        self.token = [-1]  # the token that ends at a node
        for t, symbols in self.spelling.items():
            node = 0
            for s in symbols:
                key = node << BITS | s
                if (node := self.step.get(key, 0)) == 0:
                    node = self.step[key] = len(self.token)
                    self.token.append(-1)
            self.token[node] = t

    def encode(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        step, token, target, order = self.step.get, self.token, self.target, self.order
        state: list = [None] * (n + 1)
        back: list = [None] * (n + 1)
        state[0] = self.start
        for j in range(n):
            lacks, node = state[j], 0
            for i in range(j, n):
                if (node := step(node << BITS | symbols[i])) is None:
                    break
                if (t := token[node]) >= 0 and not bisect_right(lacks, order[t]) & 1:
                    state[i + 1] = target[t]
                    back[i + 1] = (j, t)
        out = []
        while n:
            n, t = back[n]
            out.append(t)
        return out[::-1]


def compiled(settings: dict) -> Automaton:
    """The automaton of a byte-level BPE model."""
    model = settings["model"]
    end, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
    odd = model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if odd or any(settings.get(k) for k in ("truncation", "padding", "decoder")):
        raise ValueError("the tokenizer's settings aren't those of a plain byte-level BPE")
    base = {b: vocab.get(c) for c, b in _BYTE_OF.items()}
    if end:
        base |= {b | LAST: vocab.get(c + end) for c, b in _BYTE_OF.items()}
    if None in base.values():
        raise ValueError("the vocabulary lacks bytes")
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return Automaton(base, [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs])


class AutomatonEncoder(WordEncoder):
    """A WordEncoder whose words go through the automaton. The library normalises and pre-splits; it never merges."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        if not self.by_word:
            raise ValueError("words between blanks can't be encoded one by one with these settings")
        self.automaton = compiled(settings)
        self.labels: list[str | None] = [None] * self.size
        for t, i in settings["model"]["vocab"].items():
            self.labels[i] = t
        self.ids_of_added = {t["content"]: t["id"] for t in settings["added_tokens"]}
        for t, i in self.ids_of_added.items():
            self.labels[i] = t

    def pieces(self, text: str) -> list[bytes]:
        """The pre-split pieces of a word as bytes."""
        if _KNOWN.fullmatch(text):
            return [x.encode() for x in _PIECE.findall(text.lower())]
        text = self.tokenizer.normalizer.normalize_str(text)
        return [bytes(map(_BYTE_OF.__getitem__, p)) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, text: str) -> list[int]:
        ids = []
        for p in self.pieces(text):
            symbols = list(p)
            symbols[-1] |= LAST
            ids += self.automaton.encode(symbols)
        return ids

    def library(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        for w in words:
            word = w.rstrip(b" ")
            ids: list[int] = []
            if word.isalpha() and word.isascii():  # ASCII letters are one piece
                symbols = list(word.lower())
                symbols[-1] |= LAST
                ids = self.automaton.encode(symbols)
            elif self.special(word):
                text = word.decode()
                for part in self.cut_added(text):
                    ids += [self.ids_of_added[part]] if part in self.ids_of_added else self.merge(part)
            else:
                ids = self.merge(word.decode())
            out[w] = np.array(ids, self.dtype).tobytes()
        return out

    def cut_added(self, text: str) -> list[str]:
        """The text cut at its added tokens; of those that begin at one place the longest."""
        names, parts, at = sorted(self.ids_of_added, key=len, reverse=True), [], 0
        while at < len(text):
            found = min(((i, -len(t), t) for t in names if (i := text.find(t, at)) >= 0), default=None)
            if not found:
                break
            parts += [text[at : found[0]], found[2]]
            at = found[0] + len(found[2])
        return [p for p in [*parts, text[at:]] if p]

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the arcs that these ids stand for, a blank between."""
        labels = self.labels
        return " ".join([t for i in ids.tolist() if i < len(labels) and (t := labels[i]) is not None])


@cache
def encoder(path: str) -> AutomatonEncoder:
    """One automaton for each worker process, its memory of words kept between batches and tasks."""
    return AutomatonEncoder(path)


def _public(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("word_bpe_49k.json")


def _each(batch: pa.RecordBatch, enc: AutomatonEncoder) -> Iterator[np.ndarray]:
    """The ids of each row's text, some MB of text at a time."""
    for part in byte_slices(batch, 1, SLICE):
        found = enc.encode_batch(part.column(1))
        for x in found:
            yield np.frombuffer(x.as_buffer(), enc.dtype).astype("<u4")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id, n_tokens, ids (binary: little-endian unsigned 32-bit numbers) for each row. path is a tokenizer file that every
    worker can open, such as one that an installed package has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(_public(path))
        for b in batches:
            for part in byte_slices(b, 1, SLICE):
                ids = [x.tobytes() for x in _each(part, enc)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """encoded with the column decoded (string)."""

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        enc = encoder(_public(path))
        return pa.array([enc.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in ids], pa.string())

    return encoded.withColumn("decoded", run("ids"))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id, n_tokens and the SHA-256 of the ids and of the decoded text, one pass, nothing wide leaving the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sha = encoder(_public(path)), lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            rows = [(len(x), sha(x.tobytes()), sha(enc.decode(x).encode())) for x in _each(b, enc)]
            n, i, d = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op11_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
