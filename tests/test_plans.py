from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from folioflow.operators.check import GateError
from folioflow.plans import desks


def test_compliance(spark):
    table = spark.createDataFrame([("A Co", None), ("B", "kept"), ("Z", None)], "name string, nature string")
    ref = spark.createDataFrame([("aco", "bank")], "name string, nature string")
    out, found = desks.compliance_fill(table, ref)
    assert {r.name: r.nature for r in out.collect()} == {"A Co": "bank", "B": "kept", "Z": None}
    assert [r.entity for r in found.collect()] == ["Z"]


def test_policy(spark):
    table = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "no string")
    pol = spark.createDataFrame([("1", "10", "4", "6"), ("2", "10", "4", "5"), ("3", "1", "1", "0"), ("3", "1", "1", "0")], "no string, total string, own string, state string")
    out, found = desks.policy_fill(table, pol, "no", ["total", "own", "state"], "total", ["own", "state"])
    assert out.count() == 4
    assert sorted((r.entity, r.code) for r in found.collect()) == [("2", "composition"), ("3", "match"), ("4", "match")]


def settle(spark, company):
    cum = spark.createDataFrame([(1, "k2", "in", Decimal("5"), company), (2, "k1", "out", Decimal("3"), Decimal("-3"))], "ordinal int, no string, dir string, amount decimal(18,2), company_amount decimal(18,2)")
    export = spark.createDataFrame([("k1", "x"), ("k2", "y"), ("k9", "z")], "no string, desk string")
    return desks.settlement(cum, export, "no", ["desk"], "amount", "dir", ["out"], ["company_amount"])


def test_settlement(spark):
    old, new, found = settle(spark, Decimal("5"))
    assert [r.desk for r in old.orderBy("ordinal").collect()] == ["y", "x"]
    assert [float(r.customer_amount) for r in new.orderBy("ordinal").collect()] == [5.0, -3.0] and "company_amount" not in new.columns
    assert found.count() == 0
    assert [(r.entity, r.code) for r in settle(spark, Decimal("4.99"))[2].collect()] == [("k2", "reverse_check")]


def test_questionnaire_aborts(spark):
    df = spark.createDataFrame([("f", 1, "1. x A")], "path string, para_no int, text string")
    with pytest.raises(GateError):
        desks.questionnaire(df, spark.createDataFrame([(1, "A", 1)], "q int, choice string, points int"), [1, 2, 3, 4])


def test_print_and_scan(spark):
    items = spark.createDataFrame([("b", 1, "x", 3), ("b", 2, "y", 4)], "batch string, ordinal int, name string, pages long")
    profile = desks.PROFILES["option_confirmation"]
    assert [(r.page_from, r.page_to) for r in desks.merge_plan(items, profile, ["batch"]).orderBy("ordinal").collect()] == [(1, 4), (5, 8)]
    scan = spark.range(1, 9).select(F.lit("b").alias("batch"), F.col("id").alias("page"))
    out, found = desks.split_plan(scan, items, profile, ["batch"])
    assert [(r.page, r.name, r.item_page) for r in out.orderBy("page").collect()][3:5] == [(4, "x", 4), (5, "y", 1)]
    assert [r.code for r in found.collect()] == ["item_pages"]
    _, found = desks.split_plan(scan.union(spark.createDataFrame([("b", 9)], "batch string, page long")), items, desks.PROFILES["statement"], ["batch"])
    assert {"page_extra", "page_count"} <= {r.code for r in found.collect()}


def test_register(spark):
    fields = spark.createDataFrame([("c", "scope", "s"), ("c", "qual", None)], "case_id string, field string, value string")
    people = spark.createDataFrame([("c", "Ann", "11010519491231002X", "1"), ("c", "Bob", "11010519491231002X", None), ("c", "Bob", "12", "2")], "case_id string, name string, id_no string, phone string")
    cases, checked, found = desks.register(fields, people, ["scope", "qual"], ["name", "phone"])
    assert cases.first().scope == "s"
    assert {r.name: r.id_no for r in checked.collect()} == {"Ann": "11010519491231002X", "Bob": None}
    assert sorted(r.code for r in found.collect()) == ["conflict", "id_check", "incomplete"]


def test_statement(spark):
    df = spark.createDataFrame([("wan", Decimal("2"), Decimal("1"), Decimal("0.5")), ("yuan", Decimal("0"), Decimal("1"), None)], "unit string, assets decimal(18,2), liabilities decimal(18,2), profit decimal(18,2)")
    got = desks.statement_figures(df, {"wan": 10000, "yuan": 1}).collect()
    assert (float(got[0].net_assets), got[0].debt_ratio) == (10000.0, 0.5) and got[1].debt_ratio is None


def test_regions(spark):
    there = spark.createDataFrame([("s", 3, "x"), ("s", 4, None)], "sheet string, row int, v string")
    plan = spark.createDataFrame([("s", 3), ("s", 4)], "sheet string, row int")
    assert [r.entity for r in desks.write_region(plan, there, ["sheet", "row"], "v").collect()] == ["s:3"]
    assert desks.write_region(plan, there, ["sheet", "row"], "v", update=True).count() == 0
    assert desks.next_free_row(there, ["sheet"], "v").first().next_row == 4
