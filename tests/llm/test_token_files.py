import json
import random
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tamarack.llm import token_files as tf

from .conftest import SF

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, tf.END_ID]


def test_query_equals_library(spark, documents):
    docs = documents.sort_values("doc_id")
    ids = [plain(t) for t in docs.text]
    starts = [0, *accumulate(map(len, ids))]
    want = [(d, s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, s, x in zip(docs.doc_id, starts, ids)]
    assert sorted(map(tuple, tf.op6_token_files(spark, SF).collect())) == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab TheÀßÿµªº×  \n\t é's'llZ09.,!\x1c\x85 　́İ漢<|endoftext|>"), max_size=60) | st.text(max_size=40))
def test_words_apart_equal_the_whole_text(text):
    ids = np.frombuffer(tf.word_encoder(PATH).encode_batch(pa.array([text], pa.string()))[0].as_py(), "<u2").tolist()
    assert [*ids, tf.END_ID] == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "a", " ", "B.", "é", "|>"]), max_size=12))
def test_added_tokens_get_their_ids(parts):
    text = "".join(parts)
    ids = np.frombuffer(tf.word_encoder(PATH).encode_batch(pa.array([text], pa.string()))[0].as_py(), "<u2").tolist()
    assert [*ids, tf.END_ID] == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(st.sampled_from("ab é.,! \n漢"), max_size=12), max_size=8))
def test_texts_of_a_batch_stay_apart(texts):
    got = tf.word_encoder(PATH).encode_batch(pa.array([None, *texts, "x"], pa.string()).slice(1, len(texts)))
    assert [[*np.frombuffer(x.as_py(), "<u2").tolist(), tf.END_ID] for x in got] == [plain(t) for t in texts]


def test_every_latin_word_equals_the_library():
    words = [f"{chr(a)}{chr(b)}" for a in range(192, 256) for b in (*range(97, 100), *range(192, 256))]
    got = tf.word_encoder(PATH).encode_batch(pa.array(words))
    assert [np.frombuffer(x.as_py(), "<u2").tolist() for x in got] == [plain(w)[:-1] for w in words]


def test_words_are_taken_apart_only_where_the_file_allows_it(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        own = json.load(f)
    other = {"cased": own | {"normalizer": None}, "whole": own | {"pre_tokenizer": None}, "blank": own | {"added_tokens": [own["added_tokens"][0] | {"content": "a b"}]}}
    text = "Hello World, a b it's\n X"
    for name, file in other.items():
        (tmp_path / name).write_text(json.dumps(file), encoding="utf-8")
        enc = tf.WordEncoder(str(tmp_path / name))
        assert not enc.by_word
        want = Tokenizer.from_file(str(tmp_path / name)).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode_batch(pa.array([None, text]))[1].as_py(), enc.dtype).tolist() == want
    assert tf.word_encoder(PATH).by_word


def test_large_vocabularies_get_longer_codes(spark, tmp_path):
    rng = np.random.default_rng(3)
    ids = rng.permutation(70_000).astype("<u4")
    rows = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(np.array_split(ids, 7))], "id long, ids binary")
    files = tf.write_files(rows, f"file://{tmp_path}/big", "<u4", 70_000)
    got = sorted(map(tuple, tf.read_files(spark, f"file://{tmp_path}/big", files).collect()))
    at = 0
    for r, x in zip(got, np.array_split(ids, 7), strict=True):
        assert r[1:] == (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 700):
        counts = rng.zipf(1.3, n).clip(1, 10**9)
        lengths = tf.code_lengths(counts, 16)
        assert lengths.max() <= 16 and sum(2.0 ** -int(x) for x in lengths) <= 1
        heap = [(int(c), i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
            cost += a + b
            heapq.heappush(heap, (a + b, -len(heap)))
        free = tf.code_lengths(counts, 40)
        if n > 1:
            assert int((free.astype(np.int64) * counts).sum()) == cost
            assert int((lengths.astype(np.int64) * counts).sum()) >= cost
    assert tf.code_lengths(2 ** np.arange(40), 16).max() == 16


def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    counts = rng.zipf(1.2, 49_408).clip(1, 10**7)
    lengths = tf.code_lengths(counts)
    codes, (symbols, sizes) = tf.canonical(lengths), tf.decode_table(lengths, tf.MAX_BITS)
    for n in (1, 127, 128, 129, 5000):
        ids = rng.integers(0, len(counts), n)
        assert (tf.unpack_block(tf.pack_block(ids, codes, lengths), symbols, sizes, tf.MAX_BITS) == ids).all()


def test_documents_span_blocks_and_files(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(rng.choices(["the", "cat", "sat", "mat."], k=rng.randint(0, 900)))) for i in rng.sample(range(1000), 80)], "doc_id long, text string").repartition(4)
    folder, files = tf.token_files(docs, PATH, folder=f"file://{tmp_path}/out", file_tokens=5000)
    assert len(files) > 3 and len(list((tmp_path / "out").iterdir())) == len(files)
    rows = sorted(map(tuple, tf.read_files(spark, folder, files).collect()))
    at = 0
    for r, d in zip(rows, sorted(docs.collect())):
        ids = plain(d["text"])
        assert r == (d["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_edge_cases(spark, edge, none):
    folder, files = tf.token_files(edge, PATH)
    rows = sorted(tf.read_files(spark, folder, files).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in rows] == [None, 1, 2, 3, 4, 5, 5, 7, 8, 9]
    assert [r["n_tokens"] for r in rows if r["id"] in (2, 3, 4)] == [1, 1, 1] and rows[7]["n_tokens"] == 60_001
    folder, files = tf.token_files(none, PATH)
    assert tf.read_files(spark, folder, files).count() == 0
