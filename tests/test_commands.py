import io
import json
import zipfile
from xml.sax.saxutils import escape

import pytest

from folioflow.__main__ import main
from folioflow.operators.check import GateError
from folioflow.sinks import committed, deliver
from folioflow.sinks.workbook import workbook
from folioflow.sources import office, pdf


def run_folder(spark, base, command, n=1):
    runs = deliver.done_runs(spark, str(base), command).orderBy("started_at").collect()
    assert len(runs) == n
    return base / command / runs[-1].run_id


def sheet(path):
    return {(s, r, c): t for s, r, c, t, _ in office.xlsx_cells(path.read_bytes())}


def test_register_of_clients_and_persons(spark, tmp_path):
    form = lambda name, scope, people: workbook({"basic": [["Client form", "2"], ["name", name], ["scope", scope], *[[None]] * 3, *people]})
    scanned = lambda people: workbook({"S": [["Scanned persons"], *people]})
    good = "11010519491231002X"
    for case, files in {
        "c1": {"form.xlsx": form("Ann & Co", "trade", [["Ann Lee", "1", good], ["Bob", "2", good]]), "scan.xlsx": scanned([["ANNLEE", good], ["bob", "110105194912310021"]])},
        "c2": {"form.xlsx": form("Zed", None, [["Zoe", None, good]]), "other.xlsx": workbook({"x": [["?"]]}), "bad.xlsx": b"PK\x03\x04bad"},
    }.items():
        (tmp_path / "in" / case).mkdir(parents=True)
        for name, content in files.items():
            (tmp_path / "in" / case / name).write_bytes(content)
    rules = {
        "anchors": {"form": [[1, "A", "client form"], [2, "A", "name"]], "scan": [[1, "A", "Scanned persons"]]},
        "fields": [["form", "name", "basic", 2, "B"], ["form", "scope", "basic", 3, "B"]], "columns": ["name", "scope"],
        "persons": [{"source": "form", "template": "form", "first_row": 7, "columns": {"A": "name", "B": "phone", "C": "id_no"}}, {"source": "scan", "template": "scan", "first_row": 2, "columns": {"A": "name", "B": "id_no"}}],
        "person_columns": ["name", "phone", "id_no"],
    }
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    args = ["register", str(tmp_path / "in"), "--rules", str(tmp_path / "rules.json"), "--base", str(tmp_path / "runs")]
    main([*args, "--preview"], spark)
    assert not (tmp_path / "runs").exists()
    main(args, spark)
    folder = run_folder(spark, tmp_path / "runs", "register")
    got = sheet(folder / "workbook" / "register.xlsx")
    assert [got[("clients", 2, c)] for c in (1, 2, 3)] == ["c1", "Ann & Co", "trade"] and got[("clients", 3, 2)] == "Zed" and ("clients", 3, 3) not in got
    assert [got[("persons", 2, c)] for c in (2, 3, 4)] == ["Ann Lee", "1", good]
    assert got[("persons", 3, 2)] == "Bob" and ("persons", 3, 4) not in got and ("persons", 4, 3) not in got
    with zipfile.ZipFile(folder / "workbook" / "register.xlsx") as z:
        notes = z.read("xl/comments1.xml").decode()
        assert "form.xlsx basic B2" in notes and "form agreed" not in notes and "form agreed" in z.read("xl/comments2.xml").decode()
    codes = {(r.code, r.entity.rsplit("/", 1)[-1]) for r in spark.read.json(str(folder / "findings")).collect()}
    assert {("id_no_conflict", "Bob"), ("incomplete", "Zoe"), ("no_template", "other.xlsx:x"), ("unreadable", "bad.xlsx")} <= codes
    assert any("id_no_conflict" in r.value for r in spark.read.text(str(folder / "pending")).collect())
    assert '"ref":"B2"' in json.loads(spark.read.text(str(folder / "sources")).orderBy("value").first().value)["record"]


def test_statistics_are_added_below_and_stop_where_occupied(spark, tmp_path):
    (tmp_path / "stat.xlsx").write_bytes(workbook({"S": [["Trades of the year"], [None, "Trade No", "Price"], [None, "T1", "5"], [None, "T2", "6"]], "other": [["x"]]}))
    (tmp_path / "in").mkdir()
    for name, text in {"b.pdf": "no T4 price 8", "a.pdf": "no T3 price 7"}.items():
        (tmp_path / "in" / name).write_bytes(pdf.text_pdf([text]))
    rules = {"headers": {"no": "trade no", "price": "PRICE"}, "patterns": {"no": "no (T[0-9]+)", "price": "price ([0-9]+)"}}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    args = ["statistics", str(tmp_path / "stat.xlsx"), str(tmp_path / "in"), "--rules", str(tmp_path / "rules.json"), "--base", str(tmp_path / "runs")]
    main(args, spark)
    got = sheet(run_folder(spark, tmp_path / "runs", "statistics") / "workbook" / "stat.xlsx")
    assert [got[("S", r, c)] for r in (5, 6) for c in (2, 3)] == ["T3", "7", "T4", "8"] and got[("S", 3, 2)] == "T1" and got[("S", 1, 1)] == "Trades of the year" and got[("other", 1, 1)] == "x"
    (tmp_path / "in" / "b.pdf").write_bytes(pdf.text_pdf(["no T2 price 9"]))
    (tmp_path / "rules.json").write_text(json.dumps(rules | {"key": "no"}))
    with pytest.raises(GateError):
        main(args, spark)
    main([*args, "--update"], spark)
    got = sheet(run_folder(spark, tmp_path / "runs", "statistics", 2) / "workbook" / "stat.xlsx")
    assert (got[("S", 4, 2)], got[("S", 4, 3)], got[("S", 5, 2)]) == ("T2", "9", "T3")


def test_trading_before_and_after_stamping(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, pages in {"n1.pdf": ["T1", "x"], "n2.pdf": ["T2", "y"]}.items():
        (tmp_path / "in" / name).write_bytes(pdf.text_pdf(pages))
    same = ["--profile", "forward_confirmation", "--person", "P", "--date", "20240309", "--base", str(tmp_path / "runs")]
    main(["trading-a", str(tmp_path / "in"), *same, "--batch", "2"], spark)
    folder = run_folder(spark, tmp_path / "runs", "trading-a")
    assert [t for _, t in pdf.pdf_pages((folder / "print" / "merged.pdf").read_bytes())] == ["T1", "x", "T2", "y"]
    assert sheet(folder / "register" / "register.xlsx")[("page 1", 2, 2)] == "n2.pdf"
    scan = tmp_path / "scan.pdf"
    scan.write_bytes(pdf.text_pdf(["no T1", "", "no T2", "stamped"]))
    main(["trading-b", str(scan), *same, "--batch", "2", "--number", "no (T[0-9])"], spark)
    out = run_folder(spark, tmp_path / "runs", "trading-b")
    assert [t for _, t in pdf.pdf_pages((out / "parts" / "n2.pdf").read_bytes())] == ["no T2", "stamped"]
    with zipfile.ZipFile(io.BytesIO((out / "zip" / "scans.zip").read_bytes())) as z:
        assert z.namelist() == ["n1.pdf", "n2.pdf"]
    assert {r.name for r in committed.delivered(spark, str(out / "parts")).collect()} == {"n1.pdf", "n2.pdf"}
    with pytest.raises(GateError):  # another batch number than the record's
        main(["trading-b", str(scan), *same, "--batch", "3"], spark)
    scan.write_bytes(pdf.text_pdf(["no T1", "no T2", "", "z"]))
    with pytest.raises(GateError):  # numbers and lengths disagree
        main(["trading-b", str(scan), *same, "--batch", "2", "--number", "no (T[0-9])"], spark)
    with pytest.raises(LookupError):
        main(["trading-b", str(scan), "--profile", "holdings", "--person", "P", "--base", str(tmp_path / "runs")], spark)
    (tmp_path / "in" / "n2 (1).pdf").write_bytes(pdf.text_pdf(["T2", "y"]))
    with pytest.raises(GateError):  # a copy
        main(["trading-a", str(tmp_path / "in"), *same], spark)
    assert deliver.done_runs(spark, str(tmp_path / "runs"), "trading-b").count() == 1


def docx(path, lines):
    body = "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>" for x in lines)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')


def test_scores_of_papers_and_of_a_sheet(spark, tmp_path):
    (tmp_path / "in").mkdir()
    docx(tmp_path / "in" / "a.docx", ["Questionnaire", *(f"{q}. why? {'AB' if q == 13 else 'C'}" for q in range(1, 21))])
    rules = {"points": {q: {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5} for q in range(1, 21)}, "cuts": [20, 40, 60, 80]}
    (tmp_path / "points.json").write_text(json.dumps(rules))
    args = ["--points", str(tmp_path / "points.json"), "--base", str(tmp_path / "runs")]
    main(["score", str(tmp_path / "in"), *args], spark)
    book = run_folder(spark, tmp_path / "runs", "score") / "workbook" / "scores.xlsx"
    got = sheet(book)
    assert (got[("answers", 2, 1)], got[("answers", 2, 14)], got[("answers", 2, 22)], got[("answers", 2, 23)]) == ("a.docx", "AB", "60.0", "C4") and got[("answers", 1, 22)] == "total"
    main(["score", str(book), *args], spark)
    again = sheet(run_folder(spark, tmp_path / "runs", "score", 2) / "workbook" / "scores.xlsx")
    assert again[("answers", 2, 22)] == "60.0"
    docx(tmp_path / "in" / "b.docx", ["1. why? Z"])
    with pytest.raises(GateError):
        main(["score", str(tmp_path / "in"), *args], spark)


def test_projects_by_batch_from_the_third_row(spark, tmp_path):
    form = lambda name, amount: workbook({"form": [["Application", None], ["Name", name], ["Amount", amount]]})
    for path, content in {"spring12/b.xlsx": form("B", "5"), "spring12/a.xlsx": form("A", None), "early03/c.xlsm": form("C", "7"), "other/d.xlsx": form("D", "8"), "early03/e.xlsx": workbook({"x": [["?"]]}), "early03/f.pdf": b"%PDF-"}.items():
        (tmp_path / "in" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / path).write_bytes(content)
    rules = {"anchors": {"v1": [[1, "A", "application"], [2, "A", "name"]]}, "fields": [["v1", "name", "form", 2, "B"], ["v1", "amount", None, 3, "B"]], "columns": ["name", "amount"]}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    args = ["projects", str(tmp_path / "in"), "--rules", str(tmp_path / "rules.json"), "--base", str(tmp_path / "runs")]
    main(args, spark)
    folder = run_folder(spark, tmp_path / "runs", "projects")
    got = sheet(folder / "workbook" / "projects.xlsx")
    rows = [[got.get(("projects", row, c)) for c in (1, 2, 3, 4)] for row in (3, 4, 5, 6)]
    assert rows == [["23.0", "3.0", "C", "7"], ["24.0", "12.0", "A", None], ["25.0", "12.0", "B", "5"], ["26.0", None, "D", "8"]] and ("projects", 2, 1) not in got
    codes = {(r.code, r.entity.rsplit("/", 1)[-1]) for r in spark.read.json(str(folder / "findings")).collect()}
    assert codes == {("no_batch", "d.xlsx"), ("incomplete", "a.xlsx"), ("no_template", "e.xlsx:x")}
    main([*args, "--first-serial", "1", "--first-row", "10"], spark)
    again = sheet(run_folder(spark, tmp_path / "runs", "projects", 2) / "workbook" / "projects.xlsx")
    assert again[("projects", 10, 1)] == "1.0"


def test_policy_table_is_filled_in_a_copy(spark, tmp_path):
    rows = [["No", "Place", "Total", "Own", "Loan"], ["P1", None, None, None, None], ["P2", "there", None, None, None], ["P3", None, None, None, None], ["P4", None, None, None, None], ["P5", None, None, None, None]]
    (tmp_path / "table.xlsx").write_bytes(workbook({"S": rows}))
    (tmp_path / "in").mkdir()
    say = lambda no, place, total, own, loan: f"policy {no} at {place} total {total} own {own} loan {loan} end"
    for name, text in {"a": say("P1", "Here", "1,000.00", "400", "600"), "b": say("P2", "Elsewhere", "10", "4", "6"), "c": say("P3", "X", "10", "4", "5"), "d": say("P4", "Y", "1", "1", "0"), "e": say("P4", "Y", "1", "1", "0"), "f": say("P9", "Z", "1", "1", "0"), "g": "no number"}.items():
        (tmp_path / "in" / f"{name}.pdf").write_bytes(pdf.text_pdf([text]))
    before = (tmp_path / "table.xlsx").read_bytes()
    rules = {"key": ["A", "policy (P[0-9])"], "fields": {"B": "at (\\w+)", "C": "total ([0-9.,]+)", "D": "own ([0-9.,]+)", "E": "loan ([0-9.,]+)"}, "total": "C", "parts": ["D", "E"]}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    main(["policies", str(tmp_path / "table.xlsx"), str(tmp_path / "in"), "--rules", str(tmp_path / "rules.json"), "--base", str(tmp_path / "runs")], spark)
    folder = run_folder(spark, tmp_path / "runs", "policies")
    got = sheet(folder / "workbook" / "table.xlsx")
    assert [got.get(("S", 2, c)) for c in range(1, 6)] == ["P1", "Here", "1,000.00", "400", "600"]
    assert [got.get(("S", 3, c)) for c in range(1, 4)] == ["P2", "there", "10"]  # what was there stays
    assert not any(got.get(("S", r, c)) for r in (4, 5, 6) for c in range(2, 6))  # empty, as they were
    assert (tmp_path / "table.xlsx").read_bytes() == before
    record = {r.key: (r.policy, r.status) for r in spark.read.option("header", "true").csv(str(folder / "check")).collect()}
    assert record == {"P1": ("a.pdf", "matched"), "P2": ("b.pdf", "matched"), "P3": ("c.pdf", "composition"), "P4": (None, "duplicate"), "P5": (None, "unmatched")}
    codes = {(r.code, r.entity) for r in spark.read.json(str(folder / "findings")).collect()}
    assert {("not_in_table", "f.pdf"), ("no_number", "g.pdf"), ("occupied", f"file:{tmp_path}/table.xlsx:S:3:2")} <= {(c, e.replace("file:///", "file:/")) for c, e in codes}
