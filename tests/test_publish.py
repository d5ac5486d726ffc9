import json

import pytest
from pyspark.sql import functions as F

from folioflow.operators import check
from folioflow.operators.check import GateError
from folioflow.sinks import deliver, publish
from folioflow.sources import memo


def table(spark, k, n=5):
    return {"t": spark.range(n).withColumn("k", F.lit(k))}


def fine(tables):
    return check.findings(tables["t"], F.col("id") < 0, F.col("id"), "negative", "an id below 0", "publish")


def seen(spark, base):
    return {r.k for r in publish.read(spark, base, "p", "t").collect()}


def test_versions_and_clean_up(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(LookupError):
        publish.read(spark, base, "p", "t")
    for k in range(1, 5):
        assert publish.publish(spark, base, "p", table(spark, k), fine) == k and seen(spark, base) == {k}
    assert {r.k for r in publish.read(spark, base, "p", "t", 3).collect()} == {3}
    with pytest.raises(LookupError):
        publish.read(spark, base, "p", "t", 1)
    assert len([f for f in (tmp_path / "p").iterdir() if f.name != "pointers"]) == 2
    assert deliver.done_runs(spark, base, "p").count() == 4


def test_what_fails_the_check_is_not_published(spark, tmp_path):
    base = str(tmp_path)
    publish.publish(spark, base, "p", table(spark, 1), fine)
    bad = {"t": spark.range(-2, 3).withColumn("k", F.lit(9))}
    with pytest.raises(GateError):
        publish.publish(spark, base, "p", bad, fine)
    assert seen(spark, base) == {1} and len([f for f in (tmp_path / "p").iterdir() if f.name != "pointers"]) == 1


def test_of_two_runs_one_wins(spark, tmp_path):
    """Both begin from the same version and stage; readers see the old tables until the swap, then the winner's."""
    base = str(tmp_path)
    publish.publish(spark, base, "p", table(spark, 1), fine)
    one, two = publish.Publication(spark, base, "p"), publish.Publication(spark, base, "p")
    one.stage(table(spark, 2))
    two.stage(table(spark, 3))
    assert seen(spark, base) == {1}
    assert two.swap() == 2 and seen(spark, base) == {3}
    with pytest.raises(publish.Overtaken):
        one.swap()
    assert seen(spark, base) == {3} and not (tmp_path / "p" / one.run.id).exists()
    states = {r.state for r in spark.read.parquet(f"{base}/ledger").filter(F.col("run_id") == one.run.id).collect()}
    assert states == {"started", "overtaken"}


def test_a_pointer_that_was_cut_off_is_passed_over(spark, tmp_path):
    base = str(tmp_path)
    publish.publish(spark, base, "p", table(spark, 1), fine)
    (tmp_path / "p" / "pointers" / "00000002").write_text('{"run": "x')
    assert seen(spark, base) == {1}
    assert publish.publish(spark, base, "p", table(spark, 5), fine) == 3 and seen(spark, base) == {5}
    assert json.loads((tmp_path / "p" / "pointers" / "00000003").read_text())["tables"] == ["t"]


def files(spark, contents):
    return spark.createDataFrame([(f"f{k}", c) for k, c in enumerate(contents)], "path string, content binary").repartition(2)


def counting(spark):
    calls = spark.sparkContext.accumulator(0)

    def read(content):
        calls.add(1)
        return [(0, part) for part in content.decode().split("|") if part]

    return calls, read


def texts(pages):
    return sorted((r.path, r.page_no, r.text) for r in pages.collect())


def test_each_content_is_read_once(spark, tmp_path):
    path = str(tmp_path / "memo")
    calls, read = counting(spark)
    found = files(spark, [b"a|b", b"c", b"a|b", b""])
    want = [("f0", 1, "a"), ("f0", 2, "b"), ("f1", 1, "c"), ("f2", 1, "a"), ("f2", 2, "b")]
    assert texts(memo.read_pages_once(found, read, path)) == want and calls.value == 3
    assert texts(memo.read_pages_once(found, read, path)) == want and calls.value == 3
    assert len(texts(memo.read_pages_once(files(spark, [b"c", b"d"]), read, path))) == 2 and calls.value == 4
    memo.read_pages_once(found, read, path, version="2")
    assert calls.value == 7


def test_compaction_lost_files_and_latest_wins(spark, tmp_path):
    path = tmp_path / "memo"
    calls, read = counting(spark)
    found = files(spark, [b"a|b", b"c"])
    memo.read_pages_once(found, read, str(path))
    memo.read_pages_once(files(spark, [b"e"]), read, str(path))
    assert memo.compact(spark, str(path)) == 2 and len(list(path.iterdir())) == 1
    memo.read_pages_once(found, read, str(path))
    assert calls.value == 3
    # a later reading of a known content counts instead of the earlier one; part of a reading counts for nothing
    sha = memo.entries(spark, str(path)).filter("text = 'c'").first().sha256
    row = lambda reading, n, k, text: (sha, "1", reading, n, k, 0, True, text)
    spark.createDataFrame([row("9", 1, 1, "new")], memo.MEMO).write.parquet(str(path / "9"))
    spark.createDataFrame([row("99", 2, 1, "half")], memo.MEMO).write.parquet(str(path / "99"))
    assert texts(memo.read_pages_once(files(spark, [b"c"]), read, str(path))) == [("f0", 1, "new")]
    memo.compact(spark, str(path))
    assert texts(memo.read_pages_once(files(spark, [b"c"]), read, str(path))) == [("f0", 1, "new")] and calls.value == 3
    for file in path.rglob("*.parquet"):
        file.unlink()
    assert len(texts(memo.read_pages_once(found, read, str(path)))) == 3 and calls.value == 5


def test_outputs_by_key_in_order(spark, tmp_path):
    rows = spark.createDataFrame([(k % 3, 100 - k, f"v{k}") for k in range(60)], "day int, ordinal int, v string")
    none = check.findings(rows, F.lit(False), F.col("v"), "x", "x", "x")
    run = deliver.Run(spark, str(tmp_path), "settlement")
    run.deliver({"new": rows}, none, check.Policy.ABORT, order={"new": ["ordinal"]}, by={"new": ["day"]})
    out = spark.read.parquet(run.path("new"))
    assert sorted(p.name for p in (tmp_path / "settlement" / run.id / "new").iterdir() if p.is_dir()) == ["day=0", "day=1", "day=2"]
    assert sorted((r.day, r.ordinal, r.v) for r in out.collect()) == sorted(map(tuple, rows.collect()))
    for file in (tmp_path / "settlement" / run.id / "new").rglob("*.parquet"):
        own = [r.ordinal for r in spark.read.parquet(str(file)).collect()]
        assert own == sorted(own)
