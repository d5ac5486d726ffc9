import zlib

import pytest
from pyspark.sql import functions as F

from folioflow.llm import sharding


def shards(df, n=8):
    out = {}
    for r in sharding.shard_by_bytes(df, n).select("doc_id", "text", "size", "text_crc32", "shard", "slot", "law").collect():
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        out.setdefault(r.shard, []).append(r)
    for rows in out.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_near_equal_bytes(spark, hot):
    text = F.repeat(F.lit("é"), (F.col("id") * 7919 % 50).cast("int"))
    if hot:
        text = F.when(F.col("id") % 3 == 0, F.lit("the same text in a third of all rows")).otherwise(text)
    df = spark.range(6000).select(F.col("id").alias("doc_id"), text.alias("text")).repartition(4)
    got = shards(df)
    sizes = [sum(r.size for r in got[s]) for s in range(8)]
    assert sum(len(x) for x in got.values()) == 6000
    assert max(sizes) - min(sizes) < 0.01 * sum(sizes) / 8 + 2 * 100


def test_equal_texts_stay_together(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("text"))
    where = {}
    for s, rows in shards(df, 4).items():
        for r in rows:
            where.setdefault(r.text, set()).add(s)
    assert sum(len(x) > 1 for x in where.values()) <= 3  # only a group at a boundary is split


def test_edges(spark):
    schema = "doc_id long, text string, size string"
    assert shards(spark.createDataFrame([], schema)) == {}
    rows = [(None, None, "x"), (1, "", "x"), (1, "", "x"), (2, "w" * 100_000, "x"), (-(2**63), "a", "x")]
    assert sum(len(x) for x in shards(spark.createDataFrame(rows, schema)).values()) == 5
    same = spark.createDataFrame([(7, "t", "x")] * 50, schema)
    assert sum(len(x) for x in shards(same).values()) == 50


def test_more_buckets_than_the_most_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 40)
    monkeypatch.setattr(sharding, "LEAST_BUCKETS", 8)
    monkeypatch.setattr(sharding, "MOST_BUCKETS", 16)
    text = F.when(F.col("id") % 3 == 0, "a third of all").otherwise(F.repeat(F.lit("x"), (F.col("id") * 31 % 90).cast("int")))
    df = spark.range(5000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("mine").alias("slot"), F.lit(1).alias("shard"), F.lit("kept").alias("extra"))
    got = shards(df)
    assert sum(map(len, got.values())) == 5000
    sizes = [sum(r.size for r in got[s]) for s in range(8)]
    assert max(sizes) - min(sizes) < 0.01 * sum(sizes) / 8 + 200
    out = sharding.shard_by_bytes(df)
    assert out.columns == ["doc_id", "text", "extra", *sharding.NEW] and out.select("extra").distinct().collect() == [("kept",)]


def test_histograms_are_hash_aggregates(spark, capsys):
    keys = spark.range(10).selectExpr("id as k1", "id as k2", "1L as size")
    sharding._histogram(keys, [5])
    ends = (F.min("k1"), F.max("k2"))
    assert "SortAggregate" not in keys.groupBy(sharding._interval("k1", "k2", [5])).agg(F.sum("size"), *ends)._jdf.queryExecution().executedPlan().toString()
