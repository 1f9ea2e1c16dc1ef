"""Token-id files: canonical, length-limited Huffman codes over ids, decoded by table in independent blocks.

Documents are encoded once (words between ASCII spaces and line ends apart, which the tokenizer's own cuts never join, and
remembered in a bounded memory) and the ids written to the shared folder. The counts of all ids, summed in the cluster,
are as many as the vocabulary has entries; package-merge turns them into code lengths of at most MAX_BITS. Ids then go in
ascending document order to one file for each range of documents:

    magic, code lengths; blocks; directory (documents, block places), its place and size, magic

A block holds BLOCK ids at most and is decoded without any other: number of ids, bits, the bit offset of every STEP-th id
(the checkpoints), code bits. All checkpoints of a block are decoded side by side, each step looking up MAX_BITS bits
in one table of symbols and lengths.

Files are written under a name of the attempt and then moved, so that a task which is run again leaves the same file. The
folder has to be reachable by pyarrow (local or shared disk, s3, gs, hdfs).

Defined results: a null or empty text has the end id only; documents with equal doc_id stand in the order of their ids;
a null doc_id sorts first; texts of any length are encoded whole and may span blocks; an empty table writes no
documents and returns no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memory, materialize, scratch, table

MAGIC = b"TMKHUF01"
MAX_BITS, BLOCK, STEP = 16, 1 << 18, 128
END_ID, CACHE = 2, 400_000
#: Bytes of text that are encoded at a time (a longer text is encoded whole).
SLICE = 8_000_000
#: Ids in a file: FILE_TOKENS where there are many; on small inputs fewer, down to LEAST_TOKENS, so that each core has a file.
FILE_TOKENS, LEAST_TOKENS = 16_000_000, 2_000_000
#: Line ends to blanks; the same and A-Z to lower case.
_BLANK = bytes(32 if b == 10 else b for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b < 91 else _BLANK[b] for b in range(256))
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_LETTER = np.array([bytes([b]).isalpha() for b in range(256)])
#: Visible ASCII and the letters of Latin-1 from \u00c0 on, and how a text of these in lower case is cut.
_KNOWN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00c0-\u00ff]+")
#: A byte's letter in a byte-level vocabulary: itself where it can be seen, else the next one from 256 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SEEN)}


# --- encoding ---------------------------------------------------------------------------------------------------------


#: The steps before a tokenizer's model for which words between ASCII blanks can be encoded one by one: blanks
#: are dropped, and letters, digits and other marks are cut apart by the characters of the word alone.
BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


def by_word(settings: dict) -> bool:
    """Whether a tokenizer file's settings are such that words can be encoded one by one. An added token might hold a blank or
    reach into two words, so none may; dropout would not be remembered rightly."""
    tokens = all(t["content"] and not set(t["content"]) & set(" \n") and not any(t[k] for k in ("lstrip", "rstrip", "single_word", "normalized")) for t in settings["added_tokens"])
    model = settings["model"]
    whole = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    whole = whole and bool(model.get("end_of_word_suffix")) and not settings.get("truncation") and not settings.get("padding")
    # every byte must be there within and at the end of a word, or pieces would lose letters
    letters = [chr(_BYTE_LETTERS.get(b, b)) for b in range(256)]
    whole = whole and all(x in model["vocab"] and x + model["end_of_word_suffix"] in model["vocab"] for x in letters)
    return tokens and whole and all(settings[k] == v for k, v in BY_WORD.items())


class WordEncoder:
    """Ids of texts by a tokenizer of the tokenizers library. Where its settings allow it (see by_word), a batch is split at
    its ASCII blanks and each distinct word encoded once and remembered; otherwise whole texts go to the library. Ids are
    little-endian, of the narrowest type that holds the vocabulary."""

    def __init__(self, path: str, cache_size: int = CACHE):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        top = max([self.tokenizer.get_vocab_size() - 1, *settings["model"]["vocab"].values(), *(t["id"] for t in settings["added_tokens"])])
        self.size, self.by_word = top + 1, by_word(settings)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.added = [t["content"].lower().encode() for t in settings["added_tokens"]]
        self.words = Memory(cache_size)
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        if self.by_word:
            model = json.dumps(settings | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []})
            self.plain = Tokenizer.from_str(model)
            self.last = np.zeros(self.size, bool)
            self.last[[i for t, i in settings["model"]["vocab"].items() if t.endswith(settings["model"]["end_of_word_suffix"])]] = True

    def special(self, word: bytes) -> bool:
        """Whether an added token stands in a word, in whatever case."""
        folded = word.lower()
        return any(t in folded for t in self.added)

    def library(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words. What consists of ASCII marks, digits and letters of ASCII and Latin-1 only is cut here as BY_WORD cuts
        it (its normalisation is lower case) and goes to the model in one text, blanks between the pieces; as the last id of
        each piece ends a word, the ids are told apart again. Other words go to the library one by one."""
        width, known, pieces, n, out = self.dtype.itemsize, [], [], [], {}
        other = []
        for w in words:
            word = w.rstrip(b" ")
            if word.isalpha():  # ASCII letters
                known.append(w)
                pieces.append(word.lower())
                n.append(1)
            elif _KNOWN.fullmatch(text := word.decode()) and not self.special(word):
                cut = _PIECE.findall(text.lower())
                known.append(w)
                pieces += [x.encode() for x in cut]
                n.append(len(cut))
            else:
                other.append((w, text))
        if pieces:
            text = b"\n".join(pieces).decode("latin-1").translate(_BYTE_LETTERS | {10: " "})
            ids = np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.append(0, np.flatnonzero(self.last[ids]) + 1)
            if len(ends) != len(pieces) + 1:
                raise ValueError("a piece of a word has no last id")
            raw, at = ids.tobytes(), (ends[np.append(0, np.cumsum(n))] * width).tolist()
            out = {w: raw[x:y] for w, (x, y) in zip(known, pairwise(at), strict=True)}
        else:
            out = dict.fromkeys(known, b"")
        found = self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)
        out.update((w, array(self.code, e.ids).tobytes()) for (w, _), e in zip(other, found, strict=True))
        return out

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        """The ids of each text (string or null), as binary."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return pa.array([array(self.code, e.ids).tobytes() for e in found], pa.binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        raw = memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]].tobytes()
        offsets -= offsets[0]
        folded = raw.translate(_LOWER)
        if any(t in folded for t in self.added):  # in other cases it would be another text
            folded = raw.translate(_BLANK)
        edges = word_edges(np.frombuffer(folded, np.uint8), offsets)
        buffers = [None, pa.py_buffer(edges.astype(np.int32).tobytes()), pa.py_buffer(folded)]
        words = pa.Array.from_buffers(pa.binary(), len(edges) - 1, buffers).dictionary_encode()
        distinct = bytes_of(words.dictionary)
        self.words.add(self.library(self.words.missing(distinct)))
        pieces = list(map(self.words.young.__getitem__, distinct))
        every = np.frombuffer(b"".join(pieces), self.dtype)
        size = np.fromiter(map(len, pieces), np.int32, len(pieces)) // self.dtype.itemsize
        first = np.cumsum(size, dtype=np.int32) - size
        of = words.indices.to_numpy()
        n = size[of]
        end = np.cumsum(n, dtype=np.int32)  # the ids of a slice are at most as many as its bytes
        # word by word: its first id's place in every, and on from there
        ids = every[np.arange(int(end[-1]) if len(end) else 0, dtype=np.int32) + np.repeat(first[of] - (end - n), n)]
        ends = np.append(0, end)[np.searchsorted(edges, offsets)] * self.dtype.itemsize
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())])


def bytes_of(column: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls."""
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).tolist()
    raw = (column.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [raw[x:y] for x, y in pairwise(at)]


def word_edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin, and the end: behind blanks, at the texts' offsets, and at a mark that ends a word of ASCII letters,
    which is a piece of its own. A word keeps the blanks behind it."""
    if not len(data):
        return np.zeros(1, np.int64)
    blank = data == 32
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = blank[:-1] & ~blank[1:]
    begins[offsets] = True
    begins[0] = begins[-1] = True
    at = np.flatnonzero(_MARK[data])
    at = at[at > 0]
    at = at[_LETTER[data[at - 1]] & ((at + 1 == len(data)) | begins[at + 1] | blank[np.minimum(at + 1, len(data) - 1)])]
    begins[at] = True
    return np.flatnonzero(begins)


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def byte_slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of text; a longer text is in a slice with what stands before it."""
    size = pc.binary_length(pc.fill_null(batch.column(column), "")).to_numpy()
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // most, prepend=0)) if len(size) else []
    for at, to in pairwise([0, *(int(c) + 1 for c in cuts if c + 1 < len(size)), len(size)]):
        yield batch.slice(at, to - at)


def encode_documents(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary, little-endian, the end id last) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = word_encoder(path)
        end = pa.scalar(np.array([end_id], enc.dtype).tobytes(), pa.binary())
        for b in batches:
            for part in byte_slices(b, 1, SLICE):
                ids = pc.binary_join_element_wise(enc.encode_batch(part.column(1)), end, pa.scalar(b"", pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids binary")


# --- codes ------------------------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with at most max_bits bits for symbols 0.. with these counts (package-merge); 0
    where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols don't fit codes of {max_bits} bits")
    order = np.argsort(counts[used], kind="stable")
    leaves = counts[used][order].astype(np.float64)
    is_leaf, packages = [], np.empty(0)
    for _ in range(max_bits):
        every = np.concatenate([leaves, packages])
        rank = np.argsort(every, kind="stable")
        is_leaf.append(rank < n)
        every = every[rank]
        packages = every[: len(every) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, got = 2 * n - 2, np.zeros(n, np.int64)
    for flags in reversed(is_leaf):  # from the level of single bits down: packages taken ask for two items of the next
        own = int(flags[:take].sum())
        got[:own] += 1
        take = 2 * (take - own)
    lengths[used[order]] = got
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol (uint32; 0 where the length is 0)."""
    codes = np.zeros(len(lengths), np.uint32)
    code = last = 0
    for s in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        if n := int(lengths[s]):
            code <<= n - last
            codes[s], last = code, n
            code += 1
    return codes


def decode_table(lengths: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for each value of the next bits."""
    codes, used = canonical(lengths), np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    span = 1 << (bits - lengths[order].astype(np.int64))
    symbols, sizes = np.zeros(1 << bits, np.uint32), np.ones(1 << bits, np.uint8)
    full = int(span.sum())
    assert not len(order) or int(codes[order[0]]) == 0
    symbols[:full], sizes[:full] = np.repeat(order, span), np.repeat(lengths[order], span)
    return symbols, sizes


def pack_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    """A block: number of ids and of bits, checkpoints, code bits (most significant first)."""
    size = lengths[ids].astype(np.uint64)
    ends = np.cumsum(size)
    pos = ends - size
    bits = int(ends[-1])
    word = (pos >> np.uint64(5)).astype(np.int64)
    value = codes[ids].astype(np.uint64) << (np.uint64(64) - (pos & np.uint64(31)) - size)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(bits // 32 + 3, np.uint64)  # codes in a word don't overlap, so their sum is their union
    out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    payload = out.astype(">u4").tobytes()[: (bits + 7) // 8]
    return struct.pack("<IQ", len(ids), bits) + pos[::STEP].astype("<u4").tobytes() + payload


def unpack_block(data: bytes, symbols: np.ndarray, sizes: np.ndarray, bits: int) -> np.ndarray:
    """The ids of a block."""
    n, total = struct.unpack_from("<IQ", data)
    lanes = -(-n // STEP)
    pos = np.frombuffer(data, "<u4", lanes, 12).astype(np.int64)
    raw = np.frombuffer(data + b"\0" * 8, np.uint8, offset=12 + 4 * lanes).astype(np.uint32)
    ahead = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]  # the 32 bits from each byte on
    out = np.zeros((STEP, lanes), np.uint32)
    mask, last = np.uint32((1 << bits) - 1), n - (lanes - 1) * STEP
    for k in range(STEP):
        if k == last:
            pos = pos[:-1]
            if not len(pos):
                break
        key = ahead[pos >> 3] >> (32 - bits - (pos & 7)).astype(np.uint32) & mask
        out[k, : len(pos)] = symbols[key]
        pos = pos + sizes[key]
    return out.T.reshape(-1)[:n]


# --- files ------------------------------------------------------------------------------------------------------------


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_files(encoded: DataFrame, folder: str, dtype: str, n_symbols: int, file_tokens: int | None = None, max_bits: int = MAX_BITS) -> list[tuple[int, str, int]]:
    """Writes encoded (id bigint, ids binary) in ascending id order. Returns number, path and ids of each file: as many rows
    as files, in order. Codes are as long as the number of symbols needs, if that is over max_bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_symbols, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), dtype), minlength=n_symbols)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["symbol", "n"])

    counts = np.zeros(n_symbols, np.int64)  # at most one row for each entry of the vocabulary
    for r in encoded.select("ids").mapInArrow(count, "symbol bigint, n bigint").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        counts[r["symbol"]] = r["n"]
    max_bits, total = max(max_bits, int(np.count_nonzero(counts)).bit_length()), int(counts.sum())
    lengths = code_lengths(counts, max_bits)
    cores = encoded.sparkSession.sparkContext.defaultParallelism
    size = file_tokens or min(FILE_TOKENS, max(LEAST_TOKENS, total // (2 * cores) + 1))
    codes, n_files = canonical(lengths), max(1, -(-total // size))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        fs.create_dir(base, recursive=True)
        number = TaskContext.get().partitionId()
        final = f"{base}/part-{number:06d}.huf"
        temp = f"{base}/.{uuid.uuid4().hex}"
        docs, sizes, blocks, wait, waiting, total = [], [], [], [], 0, 0
        with fs.open_output_stream(temp, compression=None) as f:
            head = zlib.compress(lengths.tobytes())
            f.write(MAGIC + struct.pack("<II", max_bits, len(head)) + head)

            def flush(least: int) -> None:
                nonlocal wait, waiting
                if not waiting:
                    return
                ids = np.concatenate(wait)
                while len(ids) >= least and len(ids):
                    blocks.append(f.tell())
                    f.write(pack_block(ids[:BLOCK], codes, lengths))
                    ids = ids[BLOCK:]
                wait, waiting = [ids], len(ids)

            for b in batches:
                docs += b.column(0).to_pylist()
                for x in b.column(1):
                    ids = np.frombuffer(x.as_py(), dtype)
                    sizes.append(len(ids))
                    total += len(ids)
                    wait.append(ids)
                    waiting += len(ids)
                    if waiting >= BLOCK:
                        flush(BLOCK)
            flush(1)
            at = f.tell()
            directory = zlib.compress(json.dumps({"docs": docs, "sizes": sizes, "blocks": [*blocks, at]}).encode())
            f.write(directory + struct.pack("<QI", at, len(directory)) + MAGIC)
        fs.move(temp, final)
        yield pa.RecordBatch.from_pydict({"number": [number], "path": [final], "n": [total]})

    ordered = encoded.repartitionByRange(n_files, F.col("id").asc()).sortWithinPartitions("id", "ids")
    made = ordered.mapInArrow(write, "number bigint, path string, n bigint").collect()
    return sorted((r["number"], r["path"], r["n"]) for r in made)


def read_file(fs, path: str) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """Each document of a file: its id and its ids, in pieces."""
    with fs.open_input_file(path) as f:
        size = f.size()
        f.seek(size - 12 - len(MAGIC))
        at, n = struct.unpack("<QI", f.read(12))
        f.seek(at)
        directory = json.loads(zlib.decompress(f.read(n)))
        f.seek(len(MAGIC))
        bits, n = struct.unpack("<II", f.read(8))
        symbols, sizes = decode_table(np.frombuffer(zlib.decompress(f.read(n)), np.uint8), bits)
        places, have = iter(directory["blocks"]), np.zeros(0, np.uint32)
        start = next(places)
        for doc, want in zip(directory["docs"], directory["sizes"], strict=True):
            pieces = []
            while want:
                if not len(have):
                    end = next(places)
                    f.seek(start)
                    have, start = unpack_block(f.read(end - start), symbols, sizes, bits), end
                pieces.append(have[:want])
                want -= len(pieces[-1])
                have = have[len(pieces[-1]) :]
            yield doc, pieces


def read_files(spark: SparkSession, folder: str, files: list[tuple[int, str, int]]) -> DataFrame:
    """id, start, n_tokens, ids_crc32 of each document in the files. files has a row for each file, not for each document."""
    starts, rows = 0, []
    for number, path, n in files:
        rows.append((number, path, starts))
        starts += n

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                fs, _ = _fs(folder)
                out: list[tuple] = []
                for doc, pieces in read_file(fs, path):
                    crc = n = 0
                    for p in pieces:
                        crc, n = zlib.crc32(p.astype("<u4").tobytes(), crc), n + len(p)
                    out.append((doc, start, n, crc))
                    start += n
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["id", "start", "n_tokens", "ids_crc32"])
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["id", "start", "n_tokens", "ids_crc32"])

    frame = spark.createDataFrame(rows, "number bigint, path string, start bigint").repartition(max(1, len(rows)), "number")
    return frame.mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, **params) -> tuple[str, list[tuple[int, str, int]]]:
    """Encodes docs and writes its files to folder (else one in the shared folder). Returns the folder and the files."""
    spark = docs.sparkSession
    enc = WordEncoder(path)
    encoded = materialize(encode_documents(docs, path, end_id, id_col, text_col).withColumn("id", F.col("id").cast("bigint")), "token-ids")
    folder = folder or scratch(spark, "token-files")
    return folder, write_files(encoded, folder, enc.dtype.str, enc.size, **params)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder, files = token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_files(spark, folder, files).withColumnRenamed("id", "doc_id")
