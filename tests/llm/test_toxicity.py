import numpy as np
from pyspark.sql import functions as F

from folioflow.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Held out by text: no copy of a text is on both sides."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    text = docs.select("doc_id", (F.pmod(F.xxhash64("text", F.lit(9)), F.lit(4)) == 0).alias("held"))
    marked = labels.join(text, "doc_id")
    chain = toxicity.train(docs, marked.filter("not held"))
    rest = marked.filter("held").select("doc_id", "toxic")
    got = toxicity.predict(docs.join(rest, "doc_id", "left_semi"), chain).join(rest, "doc_id")
    n = {(r.toxic, r.is_toxic): r["count"] for r in got.groupBy("toxic", "is_toxic").count().collect()}
    assert n[(1, True)] / (n[(1, True)] + n.get((1, False), 0)) > 0.9
    assert n.get((0, True), 0) <= 0.01 * n[(0, False)]


def test_kinds_are_found_without_a_word_list():
    row, feature, toxic = [], [], []
    for i in range(400):
        toxic.append(i % 2 == 0)
        own = [50 + i % 7, 60 + i % 5] + ([1, 2, 3] if i % 4 == 0 else [11, 12, 13] if i % 4 == 2 else [])
        row += [i] * len(own)
        feature += own
    kinds = toxicity.kinds_of(np.array(row), np.array(feature), np.array(toxic))
    one, two = np.arange(400) % 4 == 0, np.arange(400) % 4 == 2
    assert {tuple(kinds[:, k]) for k in range(2)} == {tuple(one), tuple(two)}
    assert not toxicity.kinds_of(np.array(row), np.array(feature), np.zeros(400, bool)).any()


def test_threshold_catches_without_alarms():
    p, toxic = np.array([0.9, 0.8, 0.6, 0.5, 0.4, 0.1]), np.array([1, 1, 0, 1, 0, 0], bool)
    assert abs(toxicity._threshold(p, toxic) - 0.7) < 1e-9
    assert toxicity._threshold(p, np.zeros(6, bool)) == 0.5


def test_two_texts_under_one_id_and_null_columns(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (1, "a fine day"), (2, None), (None, None), (4, "nice")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 0), (None, None)], "doc_id long, toxic int")
    out = toxicity.predict(docs, toxicity.train(docs, labels))
    assert out.count() == 5 and out.filter("p_toxic is null or is_toxic is null").count() == 0


def test_later_models_see_out_of_fold_probabilities():
    r = np.random.default_rng(0)
    size = 400
    first = r.random(size) < 0.5
    row = np.repeat(np.arange(size), 2)
    feature = np.stack([np.where(first, 1, 2), r.integers(10, 20, size)], 1).ravel()
    chain = toxicity.Chain.fit(row, feature, np.column_stack([first, first]), ("a", "b"))
    assert len(chain.models[0].dense) == 0 and chain.models[1].dense.shape == (1,) and chain.models[1].dense[0] > 0


def test_edges(spark):
    schema = "doc_id long, text string, is_toxic string"
    docs = spark.createDataFrame([(1, "you idiot", "x"), (2, "fine words", "x"), (3, None, "x"), (3, "", "x"), (None, "idiot " * 30_000, "x")], schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (9, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.predict(docs, toxicity.train(docs, labels))
    assert out.count() == 5 and out.columns == ["doc_id", "p_kind_1", "p_kind_2", "p_toxic", "is_toxic"]
    assert out.filter(F.col("p_toxic").between(0, 1)).count() == 5
    assert toxicity.predict(docs.limit(0), toxicity.train(docs.limit(0), labels.limit(0))).count() == 0
