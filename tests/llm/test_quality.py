import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from folioflow.llm import quality, words


def test_features_are_words_and_pairs():
    texts = ["a b c", "", "b c", None, "c"]
    (_, _, data, offsets), *_ = words.chunks(pa.array(texts))
    found, at = quality.features(data, offsets)
    assert np.diff(at).tolist() == [5, 0, 3, 0, 1]
    rows = [found[at[i] : at[i + 1]].tolist() for i in range(5)]
    assert set(rows[2]) < set(rows[0]) and rows[4][0] == rows[0][2]


def test_weights_against_brute_force(spark):
    texts = [(1, "good good text here", True), (2, "bad bad words", False), (3, "good words", False), (4, None, False), (5, "", True)]
    df = spark.createDataFrame(texts, "doc_id long, text string, target boolean")
    ratios = quality.log_ratios(df)

    def buckets(text):
        (_, _, data, offsets), *_ = words.chunks(pa.array([text or ""]))
        return quality.features(data, offsets)[0]

    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for _, text, good in texts:
        for b in buckets(text):
            raw[b] += 1
            target[b] += good
    p = lambda x: np.log((x + 1) / (x.sum() + quality.BUCKETS))
    assert np.allclose(ratios, p(target) - p(raw))
    got = {r.doc_id: (r.log_weight, r.gumbel_key, r.rank_bits) for r in quality.weigh(df, ratios).collect()}
    for i, text, _ in texts:
        assert math.isclose(got[i][0], sum(ratios[b] for b in buckets(text)), abs_tol=1e-9)
    by_key = sorted(got, key=lambda i: got[i][1])
    assert by_key == sorted(got, key=lambda i: got[i][2])


def test_exactly_the_k_greatest_keys(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("w"), (F.col("id") % 17).cast("string")).alias("text"))
    labels = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 4 > 0).cast("int").alias("quality"))
    out = quality.resample(docs, labels).collect()
    order = sorted(out, key=lambda r: -r.gumbel_key)
    assert [r.selected for r in order] == [True] * 375 + [False] * 125
    assert {r.doc_id for r in out if r.selected} == {r.doc_id for r in quality.resample(docs.repartition(7), labels).filter("selected").collect()}


def test_low_quality_goes(spark):
    sf = "/root/testdata/sf0.1"  # about 4000 labels; fewer don't make a model
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.resample(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id")
    by = {r.quality: r.s for r in out.groupBy("quality").agg(F.avg(F.col("selected").cast("double")).alias("s")).collect()}
    assert by[1] > 0.95 and by[0] < 0.2


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a"), (1, None), (1, None), (2, "b" * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([(None, 1), (9, None)], "doc_id long, quality int")
    assert quality.resample(docs, none).filter("selected and log_weight = 0").count() == 4
    assert quality.resample(docs.limit(0), none).count() == 0
    assert quality.resample(docs, none, share=0.0).filter("selected").count() == 0


def test_whole_query_against_plain_counts(spark):
    """Every row's weight from plain counts of target and raw text; the k greatest keys, k from the labels' share."""
    docs = [(i, " ".join(("good" if i % 3 else "bad") + str((i * j) % 11) for j in range(1, 1 + i % 9))) for i in range(300)] + [(300, None), (301, "")]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(None, 1), (4, None), (4, 1)]
    out = quality.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(labels, "doc_id long, quality int"), target_rows=10**6).collect()
    good = {i for i, q in labels if i is not None and q == 1}
    known = {i for i, q in labels if i is not None and q is not None}

    def buckets(text):
        (_, _, data, offsets), *_ = words.chunks(pa.array([text or ""]))
        return quality.features(data, offsets)[0]

    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, text in docs:
        np.add.at(raw, buckets(text), 1)
        if i in good:
            np.add.at(target, buckets(text), 1)
    p = lambda x: np.log((x + 1) / (x.sum() + quality.BUCKETS))
    ratio = p(target) - p(raw)
    assert all(math.isclose(r.log_weight, ratio[buckets(dict(docs)[r.doc_id])].sum(), abs_tol=1e-9) for r in out)
    k = round(len(good) / len(known) * len(docs))
    keys = sorted((r.gumbel_key for r in out), reverse=True)
    assert {r.doc_id for r in out if r.selected} == {r.doc_id for r in out if r.gumbel_key >= keys[k - 1]} and sum(r.selected for r in out) == k


def test_rows_without_an_id_and_ids_of_text(spark):
    none = spark.createDataFrame([], "doc_id string, quality int")
    rows = [(None, f"text {k}", 1.0, 2) for k in range(1000)] + [(f"id {k}", "same text", 1.0, 2) for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id string, text string, gumbel_key double, tie int")
    out = quality.resample(df, none, share=0.5)
    assert out.columns == ["doc_id", "log_weight", "gumbel_key", "selected"]
    assert out.filter("selected").count() == 750 and 400 < out.filter("selected and doc_id is null").count() < 600
