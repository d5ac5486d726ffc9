import io
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from folioflow.operators.check import GateError, Policy, findings
from folioflow.schemas import SCHEMAS
from folioflow.sinks import deliver
from folioflow.sinks.workbook import workbook
from folioflow.sources import office, places, seams
from folioflow.streaming import intake


@pytest.fixture()
def folder(tmp_path):
    top = tmp_path / "cases" / "batch_07"
    top.mkdir(parents=True)
    (top / "a.xlsx").write_bytes(workbook({"S": [["name", "n"], ["Ann & Bob", 3.5], [None, 1]], "T": [["x"]]}))
    (top / "b.xls").write_text("<html><table><tr><td colspan=2>k &amp; l</td><td>v</td></tr><tr><td>1</td><td></td><td>2</td></tr></table></html>")
    with zipfile.ZipFile(top / "c.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>1. q </w:t></w:r><w:r><w:t>A</w:t></w:r></w:p><w:p/></w:body></w:document>')
    (top / "d.xls").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1legacy")
    (top / "e.xlsx").write_bytes(b"PK\x03\x04broken")
    return tmp_path / "cases"


def test_cells_from_all_kinds(spark, folder):
    found = office.files(spark, str(folder), "*.xls*")
    cells = office.read_cells(found)
    assert cells.schema.fieldNames() == SCHEMAS["cells"].fieldNames()
    got = {(r.path[-6:], r.sheet, r.row, r.col): r.raw for r in cells.collect()}
    assert got[("a.xlsx", "S", 2, 1)] == "Ann & Bob"
    assert got[("/b.xls", "table1", 1, 3)] == "v" and got[("/b.xls", "table1", 1, 1)] == "k & l" and got[("/b.xls", "table1", 2, 3)] == "2"
    assert ("a.xlsx", "S", 3, 1) not in got
    assert [float(r.num) for r in cells.filter("sheet = 'S' and row = 2 and col = 2").collect()] == [3.5]
    assert {r.sheet for r in office.read_cells(found, ["T"]).collect()} == {"T"}
    assert sorted(r.entity[-6:] for r in office.unreadable(found, cells, "read").collect()) == ["/d.xls", "e.xlsx"]


def test_paragraphs_and_material(spark, folder):
    found = office.files(spark, str(folder), "*.docx")
    assert [(r.para_no, r.text) for r in office.read_paragraphs(found).collect()] == [(1, "1. q A"), (2, "")]
    m = places.with_batch(office.material(office.files(spark, str(folder)), "run")).collect()
    assert {(r.case_id, r.batch_no) for r in m} == {("batch_07", 7)} and len(m) == 5


def test_places(spark, folder, tmp_path):
    assert places.dated("/in/", date(2024, 3, 9), "list{mmdd}-{yyyymmdd}.xls") == "/in/list0309-20240309.xls"
    assert places.first_existing(spark, [str(tmp_path), str(folder / "batch_07")], "a.xlsx").endswith("batch_07/a.xlsx")
    assert places.first_existing(spark, [str(tmp_path)], "a.xlsx") is None


def test_batch_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"batch_id":"b","person":"p","kind":"k","task_date":"2024-03-09","batch_no":7,"items":[{"ordinal":1,"name":"n","sha256":"h","pages":4,"page_from":1,"page_to":4}]}')
    batch = places.read_batches(spark, str(tmp_path / "r.json"))
    assert batch.first()["items"][0].pages == 4
    assert '"task_date":"2024-03-09"' in deliver.batch_record(batch).first().record


def test_seams(spark, folder):
    found = office.files(spark, str(folder), "*.docx")
    pages = seams.read_pages(found, lambda content: [(0, "one"), (90, "")])
    assert [(r.page_no, r.rotation, r.has_text) for r in pages.collect()] == [(1, 0, True), (2, 90, False)]
    with pytest.raises(Exception, match="no reader"):
        seams.read_pages(found).collect()
    cache = found.select(F.sha2("content", 256).alias("sha256"))
    assert seams.not_yet_read(found, cache).count() == 0


def test_delivery(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    none, bad = findings(df, F.lit(False), F.col("k"), "c", "r", "s"), findings(df, F.lit(True), F.col("k"), "c", "r", "s")
    run = deliver.Run(spark, str(tmp_path), "demo", day="20240309")
    assert run.deliver({"out": df}, none, Policy.ABORT) == 0
    assert spark.read.parquet(run.path("out")).count() == 1
    stopped = deliver.Run(spark, str(tmp_path), "demo")
    with pytest.raises(GateError):
        stopped.deliver({"out": df}, bad, Policy.ABORT)
    assert [r.run_id for r in deliver.done_runs(spark, str(tmp_path), "demo").collect()] == [run.id]
    dry = deliver.Run(spark, str(tmp_path / "dry"), "demo", dry=True)
    dry.deliver({"out": df}, none, Policy.ABORT)
    assert not (tmp_path / "dry").exists()
    assert deliver.archive(spark, run.path("out"), str(tmp_path / "archive")) and not (tmp_path / "demo" / run.id / "out").exists()
    assert deliver.archive(spark, run.path("out"), str(tmp_path / "archive")) is None
    assert deliver.pending_lines(bad).first().value == "s | error | a | c | r"


def test_workbook_round_trip(spark):
    df = spark.createDataFrame([("x<y", 1), (None, 2)], "k string, v int")
    cells = {(r, c): t for _, r, c, t, _ in office.xlsx_cells(workbook({"out": [df.columns, *df.collect()]}))}
    assert cells == {(1, 1): "k", (1, 2): "v", (2, 1): "x<y", (2, 2): "1", (3, 2): "2"}


def test_source_records(spark):
    src = ("p", "s", "C8", None)
    fields = spark.createDataFrame([("c", "e", 1, "f", "v", src, "cell", "ok"), ("c", "e", 0, "g", None, src, "cell", "blank")], SCHEMAS["fields"])
    record = deliver.source_records(fields).first().record
    assert record.index('"field":"g"') < record.index('"field":"f"') and '"ref":"C8"' in record


def test_intake_takes_each_content_once(spark, tmp_path):
    inbox, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    inbox.mkdir()
    for name, text in (("a.txt", "1"), ("b.txt", "1"), ("c.txt", "2")):
        (inbox / name).write_text(text)
    intake.take_in(intake.new_files(spark, str(inbox)), out, state)
    (inbox / "d.txt").write_text("2")
    (inbox / "e.txt").write_text("3")
    intake.take_in(intake.new_files(spark, str(inbox)), out, state)
    assert sorted(bytes(r.content) for r in spark.read.parquet(out).collect()) == [b"1", b"2", b"3"]


def test_rowspan_keeps_later_cells_in_their_columns():
    from folioflow.sources import office

    page = b"<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td><td colspan=x>d</td></tr><tr><td>e</td></tr></table>"
    assert [(r, c, t) for _, r, c, t, _ in office.html_cells(page)] == [(1, 1, "a"), (1, 2, "b"), (2, 2, "c"), (2, 3, "d"), (3, 1, "e")]


def test_plain_pages_are_split_at_their_tags_as_the_parser_would(monkeypatch):
    import random

    r = random.Random(3)
    parts = ["<table>", "</table>", "<TR>", "<tr>", "</tr>", "<td>", '<td colspan="2">', "<th ROWSPAN=\"2\">", '<td rowspan="x" >', "</td>", "</th >", "<b>", "<br/>", "<!-- <td> -->", "<td a=b>", "<td/>", "<script>", "</script>", "<title>", "</title>", "a", " ", "&nbsp;", "&amp;lt;", "&am", "<", ">", '"', "&", "1 < 2", "\n", "\xa0"]
    for _ in range(4000):
        text = "<table><tr>" + "".join(r.choice(parts[: r.choice((12, 22, 32))]) for _ in range(r.randint(0, 25)))
        want, got = office._Tables(), office._Tables()
        want.feed(text)
        office._feed(got, text)
        assert got.cells == want.cells, text
    monkeypatch.setattr(office._Tables, "feed", None)
    plain = b'<html><table><tr><td colspan="2">1</td><td> x&nbsp;</td></tr></table></html>'
    assert [c[1:4] for c in office.html_cells(plain)] == [(1, 1, "1"), (1, 3, "x")]


def test_small_workbooks_are_read_and_written_without_zipfile(monkeypatch):
    """Plain sheets of a small workbook: the frame is packed and read once for all of them; each still is a whole ZIP."""
    made = [workbook({"S": [["a", str(k)], ["b c", None]]}, mark_blank=False) for k in range(3)]
    with zipfile.ZipFile(io.BytesIO(made[2])) as z:
        assert z.testzip() is None and len(z.namelist()) == 6
    first = list(office.xlsx_cells(made[0]))
    monkeypatch.setattr(zipfile, "ZipFile", None)
    monkeypatch.setattr(office.ElementTree, "fromstring", None)
    assert workbook({"S": [["a", "1"], ["b c", None]]}, mark_blank=False) == made[1]
    assert office.sniffed(made[1]) == "xlsx" and list(office.xlsx_cells(made[1])) == [("S", 1, 1, "a", "text"), ("S", 1, 2, "1", "text"), ("S", 2, 1, "b c", "text")]
    assert [c[3] for c in first] == ["a", "0", "b c"]


def test_workbooks_out_of_the_ordinary_read_as_before():
    """What isn't plain goes to zipfile and the parser: other packing, damage, blanks, numbers, entities, several sheets."""
    odd = {"S": [["<a> & \"b\"", 3.5, None, True], ["é\n"]], "T": [["x"]]}
    cells = [("S", 1, 1, '<a> & "b"', "text"), ("S", 1, 2, "3.5", "number"), ("S", 1, 4, "True", "text"), ("S", 2, 1, "é\n", "text"), ("T", 1, 1, "x", "text")]
    content = workbook(odd)
    stored = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as z, zipfile.ZipFile(stored, "w") as out:
        for name in z.namelist():
            out.writestr(name, z.read(name))
    assert list(office.xlsx_cells(content)) == list(office.xlsx_cells(stored.getvalue())) == list(office.xlsx_cells(b"front" + content)) == cells
    assert list(office.xlsx_cells(content, {"T"})) == cells[-1:]
    at = content.rindex(b"PK\x01\x02")
    for harmed in (content[:-30], content[: at + 16] + b"\0\0\0\0" + content[at + 20 :]):  # cut short; another check sum
        with pytest.raises(office.UNREADABLE):
            list(office.xlsx_cells(harmed))
