import zlib

import pytest
from pyspark.sql import functions as F

from folioflow import catalog_desks
from folioflow.sinks import print_files
from folioflow.sources import office, pdf, seams

TEXTS = ["Trade no. T1\nsecond (line) \\ x", "é €", ""]


def test_text_round_trip():
    assert pdf.pdf_pages(pdf.text_pdf(TEXTS)) == [(0, t) for t in TEXTS]


def test_merge_pads_and_split_takes_back():
    one = pdf.merge([pdf.text_pdf(["a"]), pdf.text_pdf(["b", "c"]), pdf.text_pdf(["d"])], even=True)
    assert [t for _, t in pdf.pdf_pages(one)] == ["a", "", "b", "c", "d", ""]
    assert [pdf.pdf_pages(p) for p in pdf.split(one, [(1, 1), (3, 4)])] == [[(0, "a")], [(0, "b"), (0, "c")]]
    with pytest.raises(IndexError):
        pdf.split(one, [(6, 7)])
    doc = pdf.Document(one)
    assert {r for r, _ in pdf.pdf_pages(pdf.write(((doc, 0), (doc, 2)), turn=270))} == {270}


def test_tables_object_streams_and_broken_references():
    table = b"1 begincodespacerange <0000><FFFF> endcodespacerange 1 beginbfchar <0001> <4E2D> endbfchar 1 beginbfrange <0002> <0003> <0041> endbfrange"
    head = b"1 0 2 34 "
    body = (b"%-34s" % b"<</Type/Catalog /Pages 2 0 R>>") + b"<</Kids[3 0 R] /Rotate 90 /Resources<</Font<</F 4 0 R>> >> >>"
    packed = zlib.compress(head + body)
    stream = b"BT /F 9 Tf [<0001> -500 <00020003>] TJ 0 -12 Td <0002> Tj ET"
    content = b"%PDF-1.5\n7 0 obj <</Type/ObjStm /N 2 /First 9 /Filter/FlateDecode /Length " + b"%d>> stream\n" % len(packed) + packed + b"\nendstream endobj\n"
    content += b"3 0 obj <</Type/Page /Parent 2 0 R /Contents 5 0 R>> endobj 4 0 obj <</Type/Font /Subtype/Type0 /ToUnicode 6 0 R>> endobj "
    content += b"5 0 obj <</Length 99 0 R>> stream\n" + stream + b"\nendstream endobj 6 0 obj <</Length %d>> stream\n" % len(table) + table + b"\nendstream endobj\nstartxref 5 %%EOF"
    assert pdf.pdf_pages(content) == [(90, "中 AB\nA")]
    assert pdf.pdf_pages(pdf.merge([content])) == [(90, "中 AB\nA")]


def test_encrypted_and_broken_files_are_reported(spark):
    good = pdf.text_pdf(["x"])
    with pytest.raises(ValueError):
        pdf.Document(good.replace(b"trailer\n<<", b"trailer\n<</Encrypt 9 0 R "))
    found = spark.createDataFrame([("a", bytearray(good)), ("b", bytearray(b"%PDF-1.4 nothing")), ("c", bytearray(b""))], "path string, content binary")
    pages = seams.read_text_pdfs(found)
    assert [(r.path, r.page_no, r.has_text, r.text) for r in pages.collect()] == [("a", 1, True, "x")]
    assert sorted(r.entity for r in office.unreadable(found, pages, "read").collect()) == ["b", "c"]


def test_print_files_of_batches(spark):
    files = print_files.text_files(spark.createDataFrame([("1", ["a"]), ("2", ["b", "c"])], "path string, p array<string>"), "path", "p")
    one = print_files.merged(files.withColumn("batch", F.lit(7)), "batch", "path", even=True)
    assert [r.text for r in seams.read_text_pdfs(one.withColumnRenamed("batch", "path")).orderBy("page_no").collect()] == ["a", "", "b", "c"]
    plan = spark.createDataFrame([(7, "one", 1, 1), (7, "two", 3, 4), (7, "lost", 5, 6)], "batch int, name string, page_from int, page_to int")
    parts = print_files.split(one, plan, "batch")
    assert {r.name: [t for _, t in pdf.pdf_pages(bytes(r.content))] for r in parts.collect()} == {"one": ["a"], "two": ["b", "c"]}


def test_plain_fonts_share_one_table():
    doc = pdf.Document(pdf.text_pdf(["x", "y"]))
    fonts = [pdf._font(doc, page["Resources"]["Font"]["F1"])[1] for page in doc.pages]
    assert fonts[0] is fonts[1] and len(fonts[0]) == 256
    assert pdf._font(doc, {"Encoding": {"Differences": [65, pdf.Name("b")]}})[1][65] == "b" and fonts[0][65] == "A"


def test_values_one_after_the_other():
    syntax = pdf.Syntax(b"1 0 R 12abc -1.5 .5 1.5.2 %x\n} /A#42 [<4 1>(a\\(\\061)] <</K 7 >> true 3 0 Rx")
    got = [syntax.value() for _ in range(12)]
    assert got == [pdf.Ref(1), b"12abc", -1.5, 0.5, b"1.5.2", "AB", [b"A", b"a(1"], {"K": 7}, True, 3, 0, b"Rx"]
    with pytest.raises(EOFError):
        syntax.value()


def test_small_files_come_in_few_batches(spark, monkeypatch):
    import pyarrow as pa

    from folioflow import shipping
    from folioflow.sinks import workbook

    seen, n = [], 40
    for module in (office, print_files, workbook):
        monkeypatch.setattr(module, "map_arrow", lambda df, run, schema: seen.append(run) or shipping.map_arrow(df, run, schema))
    office.read_cells(spark.createDataFrame([], "path string, content binary"))
    print_files.merged(spark.createDataFrame([], "batch string, k int, content binary"), "batch", "k")
    workbook.workbooks(spark.createDataFrame([], "path string, v array<array<string>>"), "path", "v")
    html, one = b"<table><tr><td>a<td>b</td></tr></table>", pdf.text_pdf(["a"])
    names = pa.array([str(k) for k in range(n)])
    for run, column in zip(seen, ([html] * n, [[one, one]] * n, [[["a", "b"]]] * n), strict=True):
        out = list(run(iter([pa.RecordBatch.from_arrays([names, pa.array(column)], ["a", "b"])])))
        assert len(out) == 1 and len(set(out[0].column(0).to_pylist())) == n


def test_batches_end_by_rows_and_by_bytes():
    import pyarrow as pa

    from folioflow import shipping

    files = [([(k, str(k))] * 5, 3 << 20) for k in range(7)] + [([], 0)]
    out = list(shipping.packed(iter(files), {"a": pa.int32(), "b": pa.string()}))
    assert [b.num_rows for b in out] == [15, 15, 5] and [r for b in out for r in b.column(0).to_pylist()] == [k for k in range(7) for _ in range(5)]
    assert not list(shipping.packed(iter([([], 9)]), {"a": pa.int32()}))


def test_plain_files_are_not_taken_apart_token_by_token(monkeypatch):
    """Objects, openings and lines that stand alike in file after file: of the tenth file nearly nothing is read anew, and it reads as the first."""
    made = [pdf.text_pdf([f"Trade no. T{k:08d}\nprice 1.5", "<(second)>"]) for k in range(10)]
    first = [[text for _, text in pdf.pdf_pages(f)] for f in made[:9]]
    asked, value = [], pdf.Syntax.value
    monkeypatch.setattr(pdf.Syntax, "value", lambda self: asked.append(1) or value(self))
    assert [text for _, text in pdf.pdf_pages(made[9])] == ["Trade no. T00000009\nprice 1.5", "<(second)>"] and first[3][0] == "Trade no. T00000003\nprice 1.5"
    assert len(asked) <= 8


def test_plain_and_other_forms_read_alike():
    """The short ways only take what they read as the long one does."""
    doc = pdf.Document.__new__(pdf.Document)
    doc.objects = {}
    for data, text in (
        (b"BT /F1 11 Tf 1 2 Td <41> Tj T* <4> Tj ET", "A\n@"), (b"BT (x<41) Tj <42> Tj", "x<41B"), (b"BT %<41> Tj\n<42> Tj", "B"), (b"BT [<41> -300 <42>] TJ", "A B"),
        (b"BI /W 1 ID <41> EI <42> Tj", "B"), (b"null <42> Tj", "B"), (b"5 <42> Tj", "B"), (b"<41> Tjx <42> Tj", "B"), (b"/F1 9 Tf <41", ""),
    ):
        parts = []
        pdf._show(doc, b"/F1 9 Tf " + data, {"Font": {"F1": {}}}, parts, 8)
        assert "".join(parts) == text, data
    whole = pdf.text_pdf(["a", "b"])
    for harmed in (whole.replace(b"/Type /Page ", b"/Type /Page /X (>>\nendobj) "), whole.replace(b"/Type /Page ", b"/Type /Page %>>\n"), whole.replace(b"trailer\n", b"trailer")):
        assert [text for _, text in pdf.pdf_pages(harmed)] == ["a", "b"]
    assert pdf.text_pdf([]) == pdf.write([])


def test_merged_files_travel_once(spark, tmp_path):
    """Files go to their customer's task, and nowhere else: no join on the way."""
    orders = "o_orderkey long, o_custkey long, o_totalprice double"
    spark.createDataFrame([(1, 7, 1.0), (2, 7, 2.0), (3, 8, 3.0), (4, None, 4.0)], orders).write.parquet(str(tmp_path / "orders.parquet"))
    df = catalog_desks.QUERIES["pdf_merged"](spark, str(tmp_path))
    got = sorted((r.batch or "", r.page_no, r.trade) for r in df.collect())
    assert got == [("", 1, "00000004"), ("", 2, "00000004"), ("7", 1, "00000001"), ("7", 2, "00000001"), ("7", 3, "00000002"), ("7", 4, "00000002"), ("7", 5, "00000002"), ("7", 6, None), ("8", 1, "00000003"), ("8", 2, None)]
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
