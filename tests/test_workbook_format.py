import zipfile

import pytest
from pyspark.sql import functions as F

from folioflow.sinks.workbook import workbook
from folioflow.sources import office, workbook_format


@pytest.fixture()
def folder(tmp_path):
    for k in range(6):
        rows = [[f"r{r}c{c}-{k}" if c else r for c in range(4)] for r in range(1, 40)]
        (tmp_path / f"b{k}.xlsx").write_bytes(workbook({"data": rows, "notes": [["x", None], [None, k]]}))
    (tmp_path / "page.xls").write_text("<html><table><tr><td>k</td></tr></table></html>")
    (tmp_path / "broken.xlsx").write_bytes(b"PK\x03\x04broken")
    (tmp_path / "old.xls").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1legacy")
    return tmp_path


def load(spark, folder, **options):
    workbook_format.register(spark)
    return spark.read.format(workbook_format.FORMAT).options(**options).load(str(folder))


def test_same_cells_as_the_reader_of_whole_files(spark, folder):
    want = office.read_cells(office.files(spark, str(folder))).withColumn("path", F.substring_index("path", "/", -1))
    for size in (1, 10_000_000):
        got = workbook_format.with_numbers(load(spark, folder, bytes=size)).withColumn("path", F.substring_index("path", "/", -1))
        assert got.schema.fieldNames() == want.schema.fieldNames()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("test", [
    "sheet = 'notes'", "sheet in ('data', 'none') and row > 2 and row <= 4", "sheet = 'data' and col = 2 and row in (1, 39)", "row >= 38 and col < 2", "path like '%b3.xlsx'",
    "path like '%b%' and sheet like 'no%'", "sheet = 'nowhere'", "row = 2 and row = 3", "sheet is not null and row <=> 1", "row = 1 or col = 1", "row > 3 and raw like 'r5%'",
])
def test_filters(spark, folder, test):
    all_cells = load(spark, folder)
    assert sorted(map(str, all_cells.filter(test).collect())) == sorted(map(str, spark.createDataFrame(all_cells.collect(), all_cells.schema).filter(test).collect()))


def test_the_plan_shows_what_is_pushed(spark, folder, capsys):
    load(spark, folder).filter("sheet = 'data' and row between 2 and 3 and raw like '%1'").explain("formatted")
    text = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(sheet), IsNotNull(row), EqualTo(sheet,data), GreaterThanOrEqual(row,2), LessThanOrEqual(row,3)]" in text
    assert "Condition : (isnotnull(raw" in text and "sheet" not in text.split("Condition :")[1].split("\n")[0]


def test_other_sheets_are_not_read(folder):
    """A sheet whose bytes are damaged doesn't matter where another is asked for."""
    book = folder / "b0.xlsx"
    content = bytearray(book.read_bytes())
    with zipfile.ZipFile(book) as z:
        at = z.getinfo("xl/worksheets/sheet1.xml").header_offset + 80
    content[at : at + 40] = b"\0" * 40
    book.write_bytes(bytes(content))
    reader = workbook_format.CellReader({"path": str(book)})
    list(reader.pushFilters([workbook_format.ds.EqualTo(("sheet",), "notes")]))
    (part,) = reader.partitions()
    assert sum(b.num_rows for b in reader.read(part)) == 2
    reader = workbook_format.CellReader({"path": str(book)})
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) < 39 * 4


def test_reading_stops_behind_the_last_row(folder, monkeypatch):
    seen = []
    monkeypatch.setattr(office, "split_ref", lambda ref, f=office.split_ref: seen.append(ref) or f(ref))
    reader = workbook_format.CellReader({"path": str(folder), "glob": "b1.xlsx"})
    assert list(reader.pushFilters([workbook_format.ds.LessThan(("row",), 3), workbook_format.ds.EqualTo(("sheet",), "data")])) == []
    rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert rows == 8 and len(seen) == 8


def test_files_are_dealt_by_size(folder):
    reader = workbook_format.CellReader({"path": str(folder), "glob": "b*.xlsx", "bytes": 1})
    assert len(reader.partitions()) == 7
    list(reader.pushFilters([workbook_format.ds.StringEndsWith(("path",), "b2.xlsx")]))
    assert [p.paths[0].rsplit("/", 1)[-1] for p in reader.partitions()] == ["b2.xlsx"]


def test_paragraphs_and_split_text(spark, tmp_path):
    for k in range(3):
        with zipfile.ZipFile(tmp_path / f"q{k}.docx", "w") as z:
            z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>' + "".join(f"<w:p><w:r><w:t>{k}{n}</w:t></w:r></w:p>" for n in "abc") + "</w:body></w:document>")
    (tmp_path / "bad.docx").write_bytes(b"PK\x03\x04")
    workbook_format.register(spark)
    df = spark.read.format(workbook_format.PARAGRAPHS).load(str(tmp_path))
    assert sorted((r.path[-7:], r.para_no, r.text) for r in df.collect()) == sorted((f"q{k}.docx", n, f"{k}{c}") for k in range(3) for n, c in enumerate("abc", 1))
    assert [r.text for r in df.filter("path like '%q1.docx' and para_no > 2").collect()] == ["1c"]
    spark.createDataFrame([(1, "a|b"), (2, None), (3, "")], "id int, t string").createOrReplaceTempView("said")
    got = spark.sql("select id, p.part_no, p.text from said, lateral split_text(t, '|') p order by id, part_no").collect()
    assert [tuple(r) for r in got] == [(1, 1, "a"), (1, 2, "b"), (3, 1, "")]
