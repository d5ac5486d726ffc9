import random

import pytest
from pyspark.sql import functions as F

from folioflow.llm import components, jaccard


def sets(rows):
    def own(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    return {i: own(t) for i, t in rows}


def brute(rows):
    s, up = sets(rows), {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in s:
        for j in s:
            if i < j and s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s[i]), top(i)) for i in s}


def made(seed):
    r, docs = random.Random(seed), []
    for _ in range(20):
        base = [r.choice("abcdefghijklmnop") + str(r.randint(0, 30)) for _ in range(r.randint(3, 60))]
        for _ in range(r.choice([1, 2, 3, 12])):
            x = list(base)
            for _ in range(r.randint(0, 4)):
                x[r.randrange(len(x))] = f"z{r.randint(0, 9)}"
            docs.append(" ".join(x))
    shared = [f"q{i}" for i in range(30)]
    docs += [" ".join([f"r{k}_{i}" for i in range(r.randint(0, 12))] + shared) for k in range(25)]
    rows = list(enumerate(docs + [None, "", " \n", "One two", "one\ttwo", "one two three four five"]))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,often,salts,star,block,batch", [(3, 4, 3, 3, 4, 7), (4, 32, 64, 512, 1024, 10_000)])
def test_against_brute_force(spark, monkeypatch, seed, often, salts, star, block, batch):
    for name, v in (("OFTEN", often), ("SALTS", salts), ("STAR", star), ("BLOCK", block)):
        monkeypatch.setattr(jaccard, name, v)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = made(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()} == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_the_bound_never_rejects_a_link():
    r = random.Random(5)
    for _ in range(300):
        n = r.randint(1, 400)
        a = {r.getrandbits(64) for _ in range(n)}
        b = set(r.sample(sorted(a), r.randint(n * 3 // 4, n))) | {r.getrandbits(64) for _ in range(r.randint(0, n // 4))}
        arrays = [jaccard.np.sort(jaccard.np.array([*x], jaccard.np.uint64)) for x in (a, b)]
        differing = int(jaccard._differing(*([jaccard._signature(x)] for x in arrays))[0])
        assert differing <= len(a ^ b)
        if 4 * len(a & b) >= 3 * len(a | b):
            assert jaccard.may_link(len(a), len(b), differing)


def test_keep_one(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    df = spark.createDataFrame([(5, text, "a"), (2, text + " more", "b"), (7, None, "c"), (7, None, "c"), (None, "x", "d"), (9, "other words", "e")], "doc_id long, text string, component_id string")
    out = jaccard.keep_one(df)
    assert out.columns == df.columns and sorted(r.component_id for r in out.collect()) == ["b", "c", "c", "d", "e"]
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    star = spark.range(101, 160).select(F.col("id").alias("a"), F.lit(100).cast("long").alias("b"))
    got = {r.id: r.component for r in components.components(links.union(star)).collect()}
    assert got == {i: 0 for i in range(60)} | {i: 100 for i in range(100, 160)}


def test_keep_one_decides_each_row(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    other = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text, "gone"), (3, text + " more", "keyed"), (None, "clean and unrelated", "clean"), (None, other, "first of nulls"), (None, other, "first of nulls")]
    rows += [(8, text + " so", "gone"), (8, "another text under that key", "apart"), (9, "said again", "again"), (9, "said again", "again"), (7, None, "blank"), (7, None, "blank")]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    got = sorted(r.mark for r in jaccard.keep_one(df).collect())
    assert got == ["again", "apart", "blank", "blank", "clean", "first of nulls", "keyed"]
