import random

import pyarrow as pa
import pytest

from folioflow.llm import decontam as D
from folioflow.llm import words

SF = "/root/testdata/sf0.1"


def distance(a, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row), row.index(min(row))


def test_edit_search_against_brute_force():
    r = random.Random(5)
    for _ in range(500):
        a = bytes(r.choice(b"abc") for _ in range(r.randint(1, 12)))
        t = bytes(r.choice(b"abc") for _ in range(r.randint(0, 15)))
        assert D.edit_search(a, t) == distance(a, t)


@pytest.fixture(scope="module")
def items(spark):
    return sorted((r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())


@pytest.fixture(scope="module")
def clean(spark, items):
    rows = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 400").collect()
    finder = D.Finder(D._items([{"text": t} for _, t in items]))
    hit = {r for r, *_ in found(finder, [x.text for x in rows])}
    return [x.text for i, x in enumerate(rows) if i not in hit]


def found(finder, texts):
    out = []
    for a, _, data, offsets in words.chunks(pa.array(texts)):
        x, at, _ = D.normalised(data, offsets)
        out += [(a + r, i, e) for r, i, e, _, _ in finder.find(x, at)]
    return out


@pytest.mark.parametrize("rate,least", [(0.0, 1.0), (0.03, 0.97), (0.08, 0.85)])
def test_recall_of_edited_items(items, clean, rate, least):
    r, texts, want = random.Random(6), [], []
    for k in range(150):
        i = r.randrange(len(items))
        s = list(items[i][1])
        for _ in range(int(rate * len(s))):
            p = r.randrange(len(s))
            s[p] = r.choice([r.choice("abcdefgh "), "", s[p] + r.choice("abcdefgh")])
        base = clean[k]
        p = base.find(" ", len(base) // 3) + 1
        texts.append(base[:p] + "".join(s) + " " + base[p:])
        want.append(i)
    got = {(r, i) for r, i, _ in found(D.Finder(D._items([{"text": t} for _, t in items])), texts)}
    assert sum((k, i) in got for k, i in enumerate(want)) >= least * len(want)
    assert all(D.edit_search(*(D._items([{"text": x}])[0] for x in (items[i][1], texts[k])))[0] <= D.EDITS * len(items[i][1]) for k, i in got)


def test_rows_and_spans(spark, items):
    i, text = items[3]
    rows = [(1, "é intro " + text.upper().replace(" ", "\n ") + " end"), (2, "nothing of it"), (3, None), (3, ""), (4, text), (4, text), (None, text), (5, text + " 中 " * 9 + text)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*items, (-1, None), (-2, "short")], "item_id long, text string")
    got = [r for r in D.find_items(docs, bench).collect() if r.item_id == i]
    assert sorted((r.doc_id or 0, r.edits) for r in got) == [(0, 0), (1, 0), (4, 0), (4, 0), (5, 0), (5, 0)]
    one = next(r for r in got if r.doc_id == 1)
    assert rows[0][1][one.span_start : one.span_end].split() == text.upper().rstrip(".").split()
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 3]
    assert D.find_items(docs.limit(0), bench).count() == 0 and D.find_items(docs, bench.limit(0)).count() == 0


def test_blocks_of_a_large_benchmark_give_the_same(spark, items, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in D.find_items(docs, bench).collect() if r.edits == 0}
    monkeypatch.setattr(D, "BLOCK_BYTES", 10_000)
    assert whole and whole == {(r.doc_id, r.item_id) for r in D.find_items(docs, bench).collect() if r.edits == 0}


@pytest.mark.parametrize("rate", [0.10, 0.12, 0.15])
def test_every_item_up_to_the_limit_is_found(items, clean, rate):
    r, texts, own = random.Random(8), [], D._items([{"text": t} for _, t in items])
    for k in range(100):
        s = [bytes([b]) for b in own[k]]
        for p in r.sample(range(len(s)), int(rate * len(s))):
            s[p] = r.choice([b"x", b"", s[p] + b"x"])
        base = clean[k]
        texts.append(base[:500] + b"".join(s).decode(errors="ignore") + base[500:])
    held = [D.edit_search(own[k], D._items([{"text": t}])[0])[0] <= D.EDITS * len(own[k]) for k, t in enumerate(texts)]
    got = {(r, i) for r, i, _ in found(D.Finder(own), texts)}
    assert sum(held) > 50 and all((k, k) in got for k, h in enumerate(held) if h)


def test_many_distances_at_once():
    r = random.Random(9)
    items = [bytes(r.choice(b"abc") for _ in range(n)) for n in (10, 63, 64, 65, 130, 200)]
    text = bytes(r.choice(b"abc") for _ in range(600))
    starts = [r.randrange(500) for _ in range(60)]
    ends = [s + r.randint(0, 100) for s in starts]
    of = [k % len(items) for k in range(60)]
    got = D.least_edits(items, *(D.np.array(c) for c in (of, list(text), starts, ends))).tolist()
    assert got == [D.edit_search(items[i], text[a:b])[0] for i, a, b in zip(of, starts, ends)]


def test_letters_beyond_ascii_have_no_case():
    text = "Élan ÑANDÚ ÜBER ДОМ ΛΌΓΟΣ ẞ K Ⱥ end of it"
    assert D._items([{"text": text}]) == D._items([{"text": text.lower().replace("ς", "σ")}])


@pytest.mark.parametrize("low,high", [(0x4E00, 0x9FA0), (0x3041, 0x3090), (0x0E01, 0x0E2F)])
def test_item_inside_unspaced_text(spark, low, high):
    r = random.Random(low)
    text = "".join(chr(r.randrange(low, high)) for _ in range(600))
    item = text[201:260]
    edited = item[:20] + "".join(chr(r.randrange(low, high)) for _ in range(5)) + item[25:]
    docs = spark.createDataFrame([(1, text), (2, text.replace(item, edited)), (3, text.replace(item, ""))], "doc_id long, text string")
    got = D.find_items(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert sorted((g.doc_id, g.edits > 0) for g in got) == [(1, False), (2, True)]
    assert all((g.span_start, g.span_end) == (201, 260) for g in got)


def test_white_space_and_punctuation_of_any_script_separate():
    text = "one two three four"
    for c in " 　 、。—\u0085":
        assert D._items([{"text": text.replace(" ", c + " " + c)}]) == [text.encode()]


@pytest.mark.parametrize("size", [None, 150, 105, 80, 65, 41, 25, 12])
def test_recall_is_kept_up_to_the_limit_at_every_size(items, clean, size):
    own = [x[:size].strip() for x in D._items([{"text": t} for _, t in items])]
    own = [x for x in own if len(x) >= D.Q]
    finder = D.Finder(own)
    for rate in (0.02, 0.05, 0.08, 0.10, 0.12, 0.15):
        r, texts = random.Random(8), []
        for k, x in enumerate(own):
            s = [bytes([b]) for b in x]
            for p in r.sample(range(len(s)), int(rate * len(s))):
                s[p] = r.choice([b"x", b"", s[p] + b"x", b"e"])
            base = clean[k % len(clean)]
            texts.append(base[:500] + b"".join(s).decode(errors="ignore") + base[500:900])
        held = [k for k, t in enumerate(texts) if D.edit_search(own[k], D._items([{"text": t}])[0])[0] <= D.EDITS * len(own[k])]
        got = {(row, i) for row, i, _ in found(finder, texts)}
        assert len(held) > 100 and sum((k, k) in got for k in held) >= 0.9 * len(held), rate


def test_short_items_are_found_as_whole_words(spark):
    bench = spark.createDataFrame([("a", "Ok then"), ("b", "so"), ("c", "abcdefghi"), ("d", "..."), (None, "abcdefghx"), ("e", "é")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "ok, THEN so"), (2, "soon ok thenx"), (3, "an abcdefghi."), (4, "abcdefghij É"), (5, "x abcdefghx"), (6, "... !")], "doc_id long, text string")
    got = sorted((r.doc_id, str(r.item_id), r.edits, r.span_start, r.span_end) for r in D.find_items(docs, bench).collect())
    assert got == [(1, "a", 0, 0, 8), (1, "b", 0, 9, 11), (3, "c", 0, 3, 12), (4, "e", 0, 11, 12), (5, "None", 0, 2, 11)]
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, bench).collect()) == [2, 6]


@pytest.mark.parametrize("kind", ["int", "long", "decimal(9,2)", "date", "string"])
def test_any_type_of_item_id_and_a_very_long_text(spark, items, kind):
    import datetime
    from decimal import Decimal

    one = {"int": 3, "long": 3, "decimal(9,2)": Decimal("3.00"), "date": datetime.date(2020, 1, 2), "string": "3"}[kind]
    bench = spark.createDataFrame([(one, items[3][1])], f"item_id {kind}, text string")
    docs = spark.createDataFrame([(None, "word " * 400_000 + items[3][1] + " word" * 1000)], "doc_id long, text string")
    assert [(r.item_id, r.edits, r.span_start) for r in D.find_items(docs, bench).collect()] == [(one, 0, 2_000_000)]


def test_the_query_against_brute_force(spark):
    from folioflow.llm import queries

    sf = "/root/testdata/sf0.001"
    bench = [(r.item_id, D._items([r.asDict()])[0]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        plain = D._items([{"text": r.text}])[0]
        want |= {(r.doc_id, i, e) for i, x in bench if (e := D.edit_search(x, plain)[0]) <= D.EDITS * len(x)}
    got = {}
    for r in queries.op10_decontamination(spark, sf).collect():
        got[r.doc_id, r.item_id] = min(r.edits, got.get((r.doc_id, r.item_id), 99))
    assert want and {(*k, e) for k, e in got.items()} == want
