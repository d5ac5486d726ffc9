from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from folioflow.functions import text as X


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


def test_keys(spark):
    assert one(spark, X.match_key, " Ａcme　 Co\tLtd ") == "ａcmecoltd"
    assert one(spark, X.match_key, "　 \t") is None
    assert one(spark, X.match_key, None) is None
    assert one(spark, X.blank_to_null, " x ") == " x "
    assert one(spark, X.blank_to_null, "　") is None


def test_names_and_paths(spark):
    assert one(spark, X.two_digit_suffix, "batch_07") == "07"
    assert one(spark, X.two_digit_suffix, "batch_7") is None
    assert one(spark, X.extension, "/a.b/c.XLSX") == "xlsx"
    assert one(spark, X.extension, "/a.b/c") is None
    assert one(spark, X.file_name, "/a/b/c.txt") == "c.txt"


def test_answer_letters(spark):
    assert one(spark, X.answer_letters, "13. which of them CAA ") == ["A", "C"]
    assert one(spark, X.answer_letters, "no answer √") == []


def test_dates(spark):
    assert one(spark, X.compact_date, "20240229") == date(2024, 2, 29)
    assert one(spark, X.compact_date, "20230229") is None
    assert one(spark, X.compact_date, "2024-02") is None
    assert one(spark, lambda x: X.month_day(x, 2025), "0131") == date(2025, 1, 31)
    got = one(spark, X.period, "from 2024-1-5 to 2025/12/31")
    assert (got.start, got.end, got.open_ended) == (date(2024, 1, 5), date(2025, 12, 31), False)
    got = one(spark, X.period, "2024.01.05 onwards")
    assert (got.start, got.end, got.open_ended) == (date(2024, 1, 5), None, True)
    assert one(spark, X.period, "none").open_ended is False


def test_amounts(spark):
    scaled = lambda x: X.in_units(x, F.lit("wan"), {"wan": 10000})
    assert one(spark, scaled, Decimal("1.25"), "decimal(18,2)") == Decimal("12500")
    assert one(spark, lambda x: X.in_units(x, F.lit("?"), {"wan": 1}), Decimal("1"), "decimal(18,2)") is None
    assert one(spark, lambda x: X.ratio(x, F.lit(0)), 3.0, "double") is None
    assert one(spark, lambda x: X.flipped(x, F.lit("out"), ["out"]), Decimal("2"), "decimal(9,2)") == Decimal("-2")


def test_columns_and_ids(spark):
    assert one(spark, X.column_number, "AN") == 40
    assert one(spark, X.column_number, "ac") == 29
    assert [X.column_letters(n) for n in (1, 26, 27, 40, 703)] == ["A", "Z", "AA", "AN", "AAA"]
    assert one(spark, X.id_valid, "11010519491231002X") is True
    assert one(spark, X.id_valid, "110105194912310021") is False
    assert one(spark, X.id_valid, "12") is False
    assert one(spark, X.id_valid, None) is None


def test_pages(spark):
    assert one(spark, lambda x: X.even_pages(x, F.lit(True)), 3, "long") == 4
    assert one(spark, lambda x: X.even_pages(x, F.lit(False)), 3, "long") == 3
    assert one(spark, lambda x: X.rotated(x, -90), 0, "int") == 270
    assert one(spark, lambda x: X.business_name(x, F.lit(None), F.lit("b"), ext="pdf"), "a") == "a-b.pdf"
