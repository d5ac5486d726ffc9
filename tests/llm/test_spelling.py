import random
import re
import zlib
from collections import Counter

from folioflow.llm import spelling


def apart(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups(words):
    out = {}
    for w, n in words.items():
        near = sorted((-k, v) for v, k in words.items() if apart(w, v))
        form = near[0] if near and -near[0][0] >= 2 * n else None
        out[w] = [form and form[1], None, n, len(near), form and -form[0]]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return out


def plain(docs):
    total = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def test_automaton_numbers_and_searches():
    r = random.Random(1)
    for letters in ("ab", "abcdé"):
        forms = sorted({"".join(r.choice(letters) for _ in range(r.randint(1, 9))) for _ in range(400)} | {"a" * 300, "a" * 301, "ab" * 90})
        automaton = spelling.Automaton(forms)
        assert automaton.size == len(forms) and [automaton.number(f) for f in forms] == list(range(len(forms)))
        assert automaton.number("zz") == -1
        for form in r.sample(forms, 120):
            for half in {len(form) // 2, len(form) - len(form) // 2}:
                got = list(automaton.near(form, half))
                assert sorted(got) == [(i, f) for i, f in enumerate(forms) if apart(form, f) and f[:half] == form[:half]]


def test_variant_groups_against_all_pairs(spark):
    r = random.Random(2)
    for letters, longest in (("ab", 9), ("aeéñst", 7)):
        words = {"".join(r.choice(letters) for _ in range(r.randint(5, longest))): r.choice([3, 4, 7, 20, 90, 500]) for _ in range(500)}
        words |= {"x" * 4000: 3, "x" * 4001: 9}
        df = spark.createDataFrame([*words.items()], "word string, n long")
        got = {w.word: [w.form, w.root, w.n, w.n_near, w.form_n] for w in spelling.variant_groups(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
        assert got == groups(words)


def test_small_shards_change_nothing(spark):
    r = random.Random(3)
    words = {"".join(r.choice("abc") for _ in range(r.randint(5, 8))): r.randint(3, 50) for _ in range(300)}
    df = spark.createDataFrame([*words.items()], "word string, n long")
    rows = lambda shard: sorted(map(tuple, spelling.near_words(df, shard).collect()))
    assert rows(60) == rows(10**6)


def test_texts_against_a_plain_version(spark):
    r = random.Random(4)
    stems = ["".join(r.choice("abcdeÀéÿ×T") for _ in range(r.randint(3, 8))) for _ in range(60)]
    docs = [(i, " ".join(r.choice(stems) + r.choice(["", "", "s", "é"]) for _ in range(40)) + r.choice(["", ",", "1"])) for i in range(60)]
    docs += [(None, "hello hello Hello"), (5, None), (6, ""), (7, "one-two_three5four" * 3000), *[(8, "again again")] * 3]
    df = spark.createDataFrame([(*d, 1, "w") for d in docs], "doc_id long, text string, n int, word string")
    got = {w.word: [w.form, w.root, w.n, w.n_near, w.form_n] for w in spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    words = plain(docs)
    assert words and got == groups(words)


def test_empty_table_and_held_counts(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = [("a", "Worte WORTE worte"), ("b", "worte"), ("c", "Zweige")]
    assert dict(map(tuple, spelling.count_words(spark.createDataFrame(docs, "doc_id string, text string")).collect())) == plain(docs) == {"worte": 4}
