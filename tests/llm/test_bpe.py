import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tamarack.llm import bpe

from .conftest import SF

CODER = bpe.coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})


def test_query_equals_library(spark, documents):
    got = {r["doc_id"]: r for r in bpe.op8_byte_bpe(spark, SF).collect()}
    for d, t in zip(documents.doc_id, documents.text):
        ids = np.array(LIBRARY.encode_ordinary(t), "<u4")
        assert tuple(got[d])[1:] == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert len(got) == len(documents)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab the  \n\t é's'llZ09.,!\x1c\x85 　漢字🙂"), max_size=60) | st.text(max_size=40))
def test_any_text(text):
    ids = CODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert CODER.decode(np.array(ids, "<u4").tobytes()) == text.encode()


def test_long_pretokens():
    for text in ("a" * 20_000, "ab" * 10_000, "the" * 9_000, " " * 9_000 + "x", "".join(random.Random(1).choices("abcdeth", k=20_000))):
        assert CODER.encode(text) == LIBRARY.encode_ordinary(text)


def test_small_memory_forgets_without_harm(documents):
    small = bpe.Coder(CODER.ranks, P.PATTERN, cache_size=50)
    for t in documents.text[:40]:
        assert small.encode(t) == LIBRARY.encode_ordinary(t)


def test_rank_queue_takes_lowest_first():
    q, rng, held = bpe.RankQueue(50_000), random.Random(2), {}
    for _ in range(3000):
        r, at = rng.randrange(50_000), rng.randrange(99)
        q.put(r, at)
        held.setdefault(r, []).append(at)
    for r in sorted(held):
        assert q.take() == (r, held[r])
    assert q.take() is None


def test_edge_cases(edge, none):
    rows = bpe.decode(bpe.encode(edge)).collect()
    assert len(rows) == edge.count() and not bpe.encode(none).count() and not bpe.round_trip(none).count()
    text = {(r["doc_id"], (r["text"] or "").encode()) for r in edge.collect()}
    assert {(r["id"], bytes(r["decoded"])) for r in rows} == text


def test_memory_lets_first_comers_go():
    from tamarack.llm.common import Memory, take_turn

    m = Memory(10)
    for want in (False, True):  # a string stays from the second time on
        new = m.missing(["a", "b"])
        m.add({k: k.encode() for k in new})
        m.thin(new)
        assert ("a" in m.young) is want
    gone = []
    take_turn("x", lambda: gone.append("x"))
    take_turn("x", lambda: gone.append("x"))
    take_turn("y")
    take_turn("y")
    assert gone == ["x"]


def test_positions_of_a_rank_are_merged_at_once(monkeypatch):
    rng = random.Random(8)
    tokens = ["".join(rng.choices("aabetonrhi é漢", k=rng.randint(1, 30))).encode() for _ in range(1500)] + [b"a" * n for n in range(1, 40)]
    want = [np.array(LIBRARY._core_bpe.encode_single_piece(t), "<u4").tobytes() for t in tokens]
    for many in (1, 3, 100):  # also with every place of a rank merged as arrays
        monkeypatch.setattr(bpe, "MANY", many)
        assert CODER.merge(tokens) == want
    looked, get = [], CODER.pairs.get
    monkeypatch.setattr(CODER.pairs, "get", lambda a, b: looked.append(max(np.size(a), np.size(b))) or get(a, b))
    CODER.merge(tokens)
    assert max(looked) >= 500


def test_pair_table():
    rng = random.Random(9)
    pairs = {(rng.randrange(60), rng.randrange(60)): k for k in range(2000)}
    t = bpe.PairTable([a for a, _ in pairs], [b for _, b in pairs], list(pairs.values()))
    every = [(a, b) for a in range(61) for b in range(61)]
    assert t.get(*(np.array(x) for x in zip(*every))).tolist() == [pairs.get(p, -1) for p in every]
