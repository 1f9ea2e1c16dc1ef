import hashlib
import json
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tamarack.llm import automaton as A

from .conftest import SF

PATH = P.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = A.encoder(PATH)


def ids_of(text):
    import pyarrow as pa

    return np.frombuffer(ENCODER.encode_batch(pa.array([text]))[0].as_buffer(), ENCODER.dtype).tolist()


def by_merges(symbols, base, merges):
    """The merges one after the other, each over the whole word from left to right."""
    ids = [base[s] for s in symbols]
    for u, v, w in merges:
        at = 0
        while at + 1 < len(ids):
            if (ids[at], ids[at + 1]) == (u, v):
                ids[at : at + 2] = [w]
            at += 1
    return ids


def test_query_equals_library(spark, documents):
    got = {r["doc_id"]: r for r in A.op11_bpe_automaton(spark, SF).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for d, t in zip(documents.doc_id, documents.text):
        ids = LIBRARY.encode(t, add_special_tokens=False).ids
        assert tuple(got[d])[1:] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(LIBRARY.decode(ids, skip_special_tokens=False).encode()))
    assert len(got) == len(documents)


@settings(max_examples=600, deadline=None)
@given(st.text(st.sampled_from("ab the  \n\t é's'llZ09.,!\x1c\x85 　漢字🙂ΣİÉ́"), max_size=60) | st.text(max_size=40))
def test_any_text(text):
    ids = ids_of(text)
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.decode(np.array(ids, "<u4")) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "a", " ", "B.", "é", "|>"]), max_size=12))
def test_added_tokens(parts):
    text = "".join(parts)
    assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_words():
    rng = random.Random(1)
    for text in ("a" * 5_000, "ab" * 3_000, "the" * 2_000, "".join(rng.choices("abcdeth", k=8_000)), "!" * 3_000, "é" * 2_000):
        assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_any_merges(data):
    """Random merges, those that never apply and doubled letters among them, on all words of up to seven letters over three."""
    from itertools import product

    base, spelled, merges = {s: s for s in range(3)}, {s: (s,) for s in range(3)}, []
    for _ in range(data.draw(st.integers(0, 8))):
        u, v = data.draw(st.sampled_from(sorted(spelled))), data.draw(st.sampled_from(sorted(spelled)))
        if (both := spelled[u] + spelled[v]) not in spelled.values():
            w = len(spelled)
            spelled[w] = both
            merges.append((u, v, w))
    auto = A.Automaton(base, merges)
    words = list(product(range(3), repeat=data.draw(st.integers(0, 7))))
    for word in random.Random(7).sample(words, min(60, len(words))):
        assert auto.encode(list(word)) == by_merges(word, base, merges)


def test_settings_that_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        own = json.load(f)
    for change in ({"truncation": {"max_length": 4}}, {"model": own["model"] | {"dropout": 0.1}}, {"model": own["model"] | {"unk_token": "a"}}):
        with pytest.raises(ValueError):
            A.compiled(own | change)
    with pytest.raises(ValueError, match="two merges"):
        A.Automaton({0: 0, 1: 1}, [(0, 1, 2), (0, 1, 2)])


def test_edge_cases(edge, none):
    rows = A.decode(A.encode(edge)).collect()
    assert len(rows) == edge.count() and not A.encode(none).count() and not A.round_trip(none).count()
    texts = sorted((str(r["doc_id"]), LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids) for r in edge.collect())
    assert sorted((str(r["id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == texts
    assert all(r["decoded"] == LIBRARY.decode(np.frombuffer(r["ids"], "<u4").tolist(), skip_special_tokens=False) for r in rows)
