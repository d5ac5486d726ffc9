import random

import numpy as np
import pytest

from folioflow.llm import minhash


def shingles(text):
    words = (text or "").lower().split()
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(docs):
    """doc_id -> (n, least id reachable), all pairs."""
    sets = {i: shingles(t) for i, t in docs}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                least[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def made(seed, groups=25, size=12):
    """Groups of texts that differ in more and more words, so that links are above and below the threshold."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    out = []
    for _ in range(groups):
        base = [word() for _ in range(r.choice([1, 2, 3, 5, 8, 40, 120]))]
        for _ in range(size):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                own[r.randrange(len(own))] = word()
            out.append(" ".join(own))
    r.shuffle(out)
    return list(enumerate(out))


def found(spark, docs, schema="doc_id long, text string"):
    rows = minhash.near_duplicates(spark.createDataFrame(docs, schema).repartition(4)).collect()
    return rows


def test_pigeonhole():
    for errors, chunk_errors in ((24, 1), (24, 0), (10, 2), (7, 1)):
        keys = minhash.keys_of(64, errors, chunk_errors)
        assert {p for key in keys for p in key} <= set(range(64))
        r = random.Random(errors)
        for _ in range(300):
            wrong = set(r.sample(range(64), errors))
            assert any(not wrong & set(key) for key in keys)


def test_all_pairs_within_the_distance_share_a_key():
    r = np.random.default_rng(5)
    a = r.integers(0, 256, (200, 64), np.uint8)
    b = a.copy()
    for row in b:
        at = r.choice(64, minhash.ERRORS, replace=False)
        row[at] += 1
    assert (minhash._key_values(a) == minhash._key_values(b)).any(1).all()


def test_chance_of_a_miss_at_the_threshold():
    """Signatures of sets at a similarity of 0.85 stay within the distance."""
    r = np.random.default_rng(6)
    apart = []
    for _ in range(400):
        whole = r.integers(0, 1 << 63, 200, np.uint64)
        a, b = np.sort(whole[:185]), np.sort(whole[15:])
        signed = [np.array([minhash.words.mixed(np.array([(x * f).min()])).astype(np.uint8)[0] for f in minhash._FACTORS]) for x in (a, b)]
        apart.append((signed[0] != signed[1]).sum())
    assert max(apart) <= minhash.ERRORS and 7 < np.mean(apart) < 12


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    docs = made(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found(spark, docs)}
    assert got == brute(docs)


def test_bitmaps_bound_the_difference():
    r = np.random.default_rng(8)
    for n in (1, 5, 70, 300, 3000):
        whole = np.unique(r.integers(0, 1 << 63, 2 * n, np.uint64))
        a, others = whole[:n], [whole[k : k + n] for k in (0, 1, n // 10, n // 2)] + [whole[: 2 * n]]
        real = [len(np.setxor1d(a, x)) for x in others]
        said = minhash._differing(minhash._parity(a), [minhash._parity(x) for x in others])
        assert (said <= real).all() and said[0] == 0 and (n < 300 or said[2] > real[2] * 0.8)
        assert all(minhash.may_link(n, len(x), d) for x, d in zip(others, said) if minhash.are_linked(a, x))


def test_small_blocks_and_no_rounds(spark, monkeypatch):
    """Everything left to the comparison of all pairs of components, in many blocks, and confirmed in small stars."""
    for name, value in (("TURNS", 0), ("BLOCK", 3), ("STAR", 2)):
        monkeypatch.setattr(minhash, name, value)
    docs = made(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found(spark, docs)} == brute(docs)


def test_a_large_group_of_near_copies(spark):
    r = random.Random(7)
    base = [f"w{k}" for k in range(300)]
    docs = []
    for i in range(800):
        own = list(base)
        for _ in range(r.randint(0, 4)):
            own[r.randrange(300)] = f"x{r.random()}"
        docs.append((i, " ".join(own)))
    got = found(spark, docs)
    assert {x.component_id for x in got} == {0} and [x.doc_id for x in got if x.kept] == [0]


def test_edges(spark):
    docs = [(5, "One two"), (3, "one  TWO"), (4, None), (6, ""), (7, " \t\n"), (None, "a b c d"), (8, "A b\x0bc d"), (9, "x"), (9, "x"), (1, "w " * 50_000), (2, "w " * 60_000), (10, "é è ê"), (11, "É è ê")]
    rows = found(spark, [(i, t, "s", 1, 2, True) for i, t in docs], "doc_id long, text string, signature string, n int, print int, kept boolean")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    want = [(5, 1, 3, False), (3, 1, 3, True), (4, 0, 4, True), (6, 0, 6, True), (7, 0, 7, True), (None, 2, 8, False), (8, 2, 8, True), (9, 1, 9, True), (9, 1, 9, True), (1, 1, 1, True), (2, 1, 1, False), (10, 1, 10, True), (11, 1, 11, True)]
    assert got == sorted(want, key=str)
    assert found(spark, []) == []


def test_string_keys(spark):
    rows = found(spark, [("b", "p q r s"), ("a", "P q r s"), ("c", "t")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in rows} == {"a": "a", "b": "a", "c": "c"}
