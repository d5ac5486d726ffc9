import hashlib
import json
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.sinks import committed
from folioflow.sources import office


def tree(folder):
    return sorted(p.relative_to(folder).as_posix() for p in folder.rglob("*") if p.is_file())


def test_files_and_manifest(spark, tmp_path):
    rows = spark.range(20).select(F.concat(F.lit("d"), F.col("id") % 3, F.lit("/f"), "id", F.lit(".txt")).alias("name"), F.encode(F.repeat(F.col("id").cast("string"), 5), "utf-8").alias("content"))
    out = tmp_path / "out"
    committed.files(rows.repartition(4), str(out))
    assert len(tree(out)) == 21 and (out / "d1" / "f7.txt").read_text() == "77777"
    said = {r.name: (r.size, r.sha256) for r in committed.delivered(spark, str(out)).collect()}
    assert said["d1/f7.txt"] == (5, hashlib.sha256(b"77777").hexdigest()) and len(said) == 20
    with pytest.raises(Exception, match="holds a delivery"):
        committed.files(rows, str(out))
    assert len(tree(out)) == 21


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    bad = F.when(F.col("id") == 17, F.raise_error(F.lit("broken row"))).otherwise(F.encode(F.lit("x"), "utf-8"))
    rows = spark.range(0, 20, 1, 4).select(F.concat(F.lit("f"), "id").alias("name"), bad.cast("binary").alias("content"))
    with pytest.raises(Exception, match="broken row"):
        committed.files(rows, str(tmp_path / "out"))
    assert tree(tmp_path) == [] and committed.delivered(spark, str(tmp_path / "out")).count() == 0


def test_a_task_that_runs_twice_counts_once(tmp_path):
    writer = committed.FilesWriter(str(tmp_path))
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b"], "content": [b"1", b"2"]})
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))
    assert lost.folder != kept.folder
    writer.commit([kept, None])
    assert tree(tmp_path) == ["a", "b", "manifest.json"]
    assert [f["name"] for f in json.loads((tmp_path / "manifest.json").read_text())["files"]] == ["a", "b"]


def test_names_twice_and_bad_names(spark, tmp_path):
    writer = committed.FilesWriter(str(tmp_path / "x"))
    batch = pa.RecordBatch.from_pydict({"name": ["a"], "content": [b"1"]})
    with pytest.raises(ValueError, match="occur twice"):
        writer.commit([writer.write(iter([batch])), writer.write(iter([batch]))])
    assert tree(tmp_path / "x") == []
    for name in ("../a", "/a", "_a", "b/_x", "manifest.json", ".."):
        with pytest.raises(ValueError, match="not a name"):
            writer.write(iter([pa.RecordBatch.from_pydict({"name": [name], "content": [b""]})]))
    with pytest.raises(Exception, match="isn't overwritten"):
        committed.register(spark)
        spark.createDataFrame([("a", b"1")], "name string, content binary").write.format(committed.FILES).mode("overwrite").save(str(tmp_path / "y"))


def test_zips(spark, tmp_path):
    rows = spark.range(30).select(F.concat(F.lit("z"), F.col("id") % 2, F.lit(".zip")).alias("archive"), F.lpad(F.col("id").cast("string"), 3, "0").alias("name"), F.encode(F.col("id").cast("string"), "utf-8").alias("content"))
    committed.zips(rows, str(tmp_path / "out"))
    with zipfile.ZipFile(tmp_path / "out" / "z1.zip") as z:
        assert z.namelist() == [f"{k:03}" for k in range(1, 30, 2)] and z.read("007") == b"7"


def test_workbooks_with_blanks_and_notes(spark, tmp_path):
    rows = spark.createDataFrame([(f"b{b}.xlsx", s, f"S{s}", r, f"{b}&{s}", None if r == 3 else r / 2, "seen <here>" if r == 2 else None) for b in range(2) for s in (1, 2) for r in (3, 1, 2)], "workbook string, sheet_no int, sheet string, row int, t string, n double, note string")
    cells = F.array(committed.cell("t", F.when(F.col("sheet_no") == 2, F.col("note"))), committed.number_cell("n"))
    committed.workbooks(rows.select("workbook", "sheet_no", "sheet", "row", cells.alias("cells")), str(tmp_path / "out"))
    content = (tmp_path / "out" / "b1.xlsx").read_bytes()
    got = {(s, r, c): (t, k) for s, r, c, t, k in office.xlsx_cells(content)}
    assert got[("S2", 2, 1)] == ("1&2", "text") and got[("S1", 1, 2)] == ("0.5", "number") and ("S1", 3, 2) not in got and len(got) == 10
    with zipfile.ZipFile(tmp_path / "out" / "b1.xlsx") as z:
        assert 's="1"' in z.read("xl/worksheets/sheet1.xml").decode() and "xl/comments1.xml" not in z.namelist()
        (note,) = ElementTree.fromstring(z.read("xl/comments2.xml")).iter(f"{office.SHEET}comment")
        assert note.get("ref") == "A2" and "".join(note.itertext()) == "seen <here>"
        assert all(ElementTree.fromstring(z.read(n)) is not None for n in z.namelist() if n.endswith((".xml", ".rels", ".vml")))
    twice = spark.createDataFrame([("b.xlsx", 1, "S", 1), ("b.xlsx", 1, "S", 1)], "workbook string, sheet_no int, sheet string, row int").select("*", F.array(committed.cell(F.lit("x"))).alias("cells"))
    with pytest.raises(Exception, match="comes twice"):
        committed.workbooks(twice, str(tmp_path / "again"))
    assert tree(tmp_path / "again") == []
