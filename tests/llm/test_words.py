import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.llm import words

TEXTS = st.lists(st.text(alphabet="aAbBé \n\t中x", max_size=30), max_size=8)


def split(text):
    low = text.translate({c: c + 32 for c in range(65, 91)})
    return re.findall("[^\x20\x09-\x0d]+", low)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_equal_words_and_shingles_have_equal_hashes(texts):
    known, shingles_known = {}, {}
    for a, b, data, offsets in words.chunks(pa.array(texts, pa.string()), 40):
        hashed, first = words.word_hashes(data, offsets)
        runs, at = words.shingle_hashes(hashed, first)
        for i in range(a, b):
            own = split(texts[i])
            got = hashed[first[i - a] : first[i - a + 1]]
            assert len(got) == len(own)
            for w, h in zip(own, got.tolist()):
                assert known.setdefault(w, h) == h
            want = [tuple(own[k : k + 5]) for k in range(len(own) - 4)] if len(own) >= 5 else [tuple(own)] if own else []
            got = runs[at[i - a] : at[i - a + 1]]
            assert len(got) == len(want)
            for w, h in zip(want, got.tolist()):
                assert shingles_known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known) and len(set(shingles_known.values())) == len(shingles_known)


def test_chunks_cover_everything():
    texts = ["a" * 100, None, "", "bc", "d" * 5] * 3
    rows = []
    for a, b, data, offsets in words.chunks(pa.array(texts, pa.string()).slice(1), 10):
        raw = data.tobytes()
        rows += [(a + i, raw[offsets[i] : offsets[i + 1]].decode()) for i in range(b - a)]
    assert rows == list(enumerate(t or "" for t in texts[1:]))
    assert list(words.chunks(pa.array([], pa.string()))) == []


def test_row_sums():
    assert words.row_sums(np.array([1.0, 2.0, 4.0]), np.array([0, 2, 2, 3])).tolist() == [3.0, 0.0, 4.0]
