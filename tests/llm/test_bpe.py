import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import bpe, words

ALPHABET = [*"abst'dmrevl  \n\t 12é½.,!-  　中😀", "'re", "'ll", "'ve", "'s", " '", "́"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def peer(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    return bpe.Codec(ranks)


def encoded(codec, texts, chunk=1 << 20):
    ids, back = [], []
    for a, b, data, offsets in words.chunks(pa.array(texts, pa.string()), chunk):
        got, starts, first = codec.encode(data, offsets)
        ids += [got[first[i] : first[i + 1]].tolist() for i in range(b - a)]
        back += codec.decode(got, starts, first)
    return ids, back


def test_same_as_tiktoken(codec, peer):
    r = random.Random(1)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30))) for _ in range(5000)]
    texts += ["", "a" * 5000, " " * 300, "x y" * 99 + "\n\n ", "ab" * 20000, "<|endoftext|>"]
    ids, back = encoded(codec, texts, 5000)
    assert ids == [peer.encode_ordinary(t) for t in texts]
    assert back == [t.encode() for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=4))
def test_any_unicode(codec, peer, texts):
    ids, back = encoded(codec, texts)
    assert ids == [peer.encode_ordinary(t) for t in texts] and back == [t.encode() for t in texts]


def test_long_slices_merge_alike(ranks):
    merger = bpe.Merger(ranks, limit=3)
    r = random.Random(2)
    for n in (2, 40, 99):
        piece = bytes(r.choice(b"theinandof") for _ in range(n))
        merger.learn([piece])
        assert merger[piece] == bpe.np.array(merger._long(piece), bpe.np.int32).tobytes()


def test_scan_is_the_automaton_run_step_by_step():
    r = bpe.np.random.default_rng(3)
    symbols = r.integers(0, 8, 1000)
    state, after = bpe.NEW, bpe._scan(bpe.FUNCTION[0][symbols])
    for i, x in enumerate(symbols):
        state = bpe._step(state, x)[0]
        assert bpe.APPLY[after[i], bpe.NEW] == state


def test_columns(spark, ranks, peer):
    rows = [(1, "Hello wörld's  end\n"), (2, None), (3, ""), (3, "repeat"), (3, "repeat"), (None, "x" * 3000)]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, ids string").repartition(2)
    out = bpe.decode(bpe.encode(df, ranks), ranks)
    got = {(r.doc_id, bytes(r.bytes)): (list(r.ids), list(r.starts)) for r in out.collect()}
    assert out.count() == 6
    for doc, text in rows:
        ids, starts = got[(doc, (text or "").encode())]
        assert ids == peer.encode_ordinary(text or "")
        assert starts == [len(b"".join(peer.decode_single_token_bytes(t) for t in ids[:k])) for k in range(len(ids))]
    digest = bpe.digest(out).filter("doc_id = 1").first()
    assert digest.ids_sha256 == hashlib.sha256(",".join(map(str, peer.encode_ordinary(rows[0][1]))).encode()).hexdigest()
    assert bpe.digest(bpe.decode(bpe.encode(df.limit(0), ranks), ranks)).count() == 0
