import hashlib
import re

from pyspark.sql import functions as F

from folioflow.llm import dedup_exact

TEXTS = ["a  b", "a\tb", " a b", "", None, "a b", "x" * 50_000, "x" * 50_000, "a\x0bb", "a b", "é"]


def brute(rows):
    norm = {i: re.sub("[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    out = set()
    for i, n in norm.items():
        same = [j for j, m in norm.items() if m == n]
        out.add((i, min(same), len(same), i == min(same), hashlib.sha256(n.encode()).hexdigest()))
    return out


def test_against_brute_force_even_when_every_hash_collides(spark):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for how in (dedup_exact.md5_128, lambda t: F.unhex(F.rpad(F.hex(F.length(t) % 2), 32, "0")), lambda t: F.lit(b"0" * 16)):
        assert {tuple(r) for r in dedup_exact.duplicate_groups(df, how).collect()} == brute(rows)
        kept = {r.doc_id for r in dedup_exact.drop_exact_duplicates(df, how).collect()}
        assert kept == {r[0] for r in brute(rows) if r[3]}


def test_hot_group_and_clashing_columns(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"), F.lit("mine").alias("keep_id"), F.lit(1).alias("group_size"))
    out = dedup_exact.drop_exact_duplicates(df)
    assert out.columns == df.columns and out.count() == 4000 - 1334 + 1
    assert {r.keep_id for r in out.collect()} == {"mine"}
    assert dedup_exact.duplicate_groups(df).filter("group_size = 1334 and keep_id = 0").count() == 1334


def test_edges(spark):
    schema = "doc_id long, text string"
    assert dedup_exact.duplicate_groups(spark.createDataFrame([], schema)).count() == 0
    got = dedup_exact.duplicate_groups(spark.createDataFrame([(None, "a"), (5, "a"), (5, "a"), (None, "b")], schema)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got if r.doc_id) == [(5, 5, 3, True)] * 2
    assert sorted(((r.keep_id, r.kept) for r in got if r.doc_id is None), key=str) == [(5, False), (None, True)]


def test_one_row_of_each_text_stays(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a ", 1), (None, "a", 1), (5, "b", 2), (5, "b", 2), (None, "b", 2), (5, "c", 3), (None, "d", 4)], "doc_id long, text string, n int")
    got = sorted((r.n, r.doc_id or 0) for r in dedup_exact.drop_exact_duplicates(df).collect())
    assert got == [(1, 0), (1, 0), (2, 5), (3, 5), (4, 0)]
