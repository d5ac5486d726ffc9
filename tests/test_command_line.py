import zipfile

import pytest

from folioflow.__main__ import main
from folioflow.operators.check import GateError
from folioflow.sinks import deliver
from folioflow.sinks.workbook import workbook
from folioflow.sources import pdf


def test_compliance_from_workbooks(spark, tmp_path, capsys):
    (tmp_path / "A.xlsx").write_bytes(workbook({"s": [["no", "name", "nature"], [1, "A Co", None], [2, "B", "kept"], [3, "Z", None]]}))
    (tmp_path / "B.xlsx").write_bytes(workbook({"s": [["no", "name", "x", "nature"], [1, "aco", "x", "bank"]]}))
    args = ["compliance", str(tmp_path / "A.xlsx"), str(tmp_path / "B.xlsx"), "--base", str(tmp_path / "runs")]
    main([*args, "--preview"], spark)
    assert not (tmp_path / "runs").exists() and "1 findings" in capsys.readouterr().out
    main(args, spark)
    (run,) = deliver.done_runs(spark, str(tmp_path / "runs"), "compliance").collect()
    folder = f"{tmp_path}/runs/compliance/{run.run_id}"
    assert {r.name: r.nature for r in spark.read.parquet(f"{folder}/filled").collect()} == {"A Co": "bank", "B": "kept", "Z": None}
    names = deliver.zip_folder(spark, folder, f"{tmp_path}/out")
    with zipfile.ZipFile(tmp_path / "out" / "delivery.zip") as z:
        assert sorted(z.namelist()) == names and any(n.startswith("filled/part-") for n in names)


def test_list_and_query(spark, tmp_path, capsys):
    main(["list"])
    assert "fill_nature" in capsys.readouterr().out
    main(["query", "serial_rows", "/root/testdata/sf0.001", "--output", str(tmp_path / "q")], spark)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 150


def test_settlement_in_the_lists_order(spark, tmp_path):
    rows = [["a", "b", "no", "amount", "company", "way"], [0, 0, "k2", 5, -5, "out"], [0, 0, "k1", 7.25, 7.25, "in"]]
    (tmp_path / "list.xlsx").write_bytes(workbook({"s": rows}))
    (tmp_path / "export.xlsx").write_bytes(workbook({"s": [["v", "no"], ["x", "k1"], ["y", "k2"]]}))
    args = ["settlement", str(tmp_path / "list.xlsx"), str(tmp_path / "export.xlsx"), "--base", str(tmp_path / "runs"), "--columns", "C,D,E,F,B,A", "--outgoing", "out"]
    main(args, spark)
    (run,) = deliver.done_runs(spark, str(tmp_path / "runs"), "settlement").collect()
    folder = f"{tmp_path}/runs/settlement/{run.run_id}"
    assert [(r.contract, r.value) for r in spark.read.parquet(f"{folder}/old").collect()] == [("k2", "y"), ("k1", "x")]
    new = spark.read.parquet(f"{folder}/new")
    assert "company_amount" not in new.columns and [float(r.customer_amount) for r in new.orderBy("ordinal").collect()] == [-5, 7.25]
    (tmp_path / "export.xlsx").write_bytes(workbook({"s": [["v", "no"], ["x", "k1"]]}))
    with pytest.raises(GateError):
        main(args, spark)
    assert deliver.done_runs(spark, str(tmp_path / "runs"), "settlement").count() == 1


def test_policy_merge_and_texts(spark, tmp_path):
    (tmp_path / "t.xlsx").write_bytes(workbook({"s": [["no", "total", "own", "loan"], ["p1", 10, 4, 6], ["p2", 10, 4, 5], ["p3", 1, 1, 0]]}))
    (tmp_path / "p.xlsx").write_bytes(workbook({"s": [["no", "v"], ["p1", "a"], ["p2", "b"]]}))
    base = str(tmp_path / "runs")
    main(["policy", str(tmp_path / "t.xlsx"), str(tmp_path / "p.xlsx"), "--base", base], spark)
    (run,) = deliver.done_runs(spark, base, "policy").collect()
    folder = f"{base}/policy/{run.run_id}"
    assert [(r.contract, r.value) for r in spark.read.parquet(f"{folder}/filled").collect()] == [("p1", "a"), ("p2", "b"), ("p3", None)]
    assert {(r.entity, r.code) for r in spark.read.json(f"{folder}/findings").collect()} == {("p2", "composition"), ("p3", "match")}
    for name, pages in {"x01/a": ["1"], "x01/b": ["2", "3"], "x02/c": ["4"]}.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"{name}.pdf").write_bytes(pdf.text_pdf(pages))
    main(["merge", str(tmp_path / "in"), "--base", base, "--even"], spark)
    (run,) = deliver.done_runs(spark, base, "trading").collect()
    got = {r.batch: [t for _, t in pdf.pdf_pages(bytes(r.content))] for r in spark.read.parquet(f"{base}/trading/{run.run_id}/merged").collect()}
    assert got == {"x01": ["1", "", "2", "3"], "x02": ["4", ""]}
    main(["texts", str(tmp_path / "in"), "--base", base], spark)
    (run,) = deliver.done_runs(spark, base, "texts").collect()
    assert [r.text for r in spark.read.parquet(f"{base}/texts/{run.run_id}/pages").collect()] == ["1", "2", "3", "4"]
