from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from folioflow import catalog
from folioflow.operators import check, extract, match, number, score
from folioflow.operators.check import GateError, Policy


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_cardinality_join(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, i int")
    right = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z"), (None, "w")], "k string, v string")
    assert rows(match.cardinality_join(left, right, "k", ["v"])) == [("a", 1, "x", "matched"), ("b", 2, None, "duplicate"), ("c", 3, None, "unmatched"), (None, 4, None, "unmatched")]


def test_fill_by_name_keeps_what_is_there(spark):
    table = spark.createDataFrame([("A b", None), ("c", "old"), ("d", None), ("e", None), (None, None)], "name string, nature string")
    ref = spark.createDataFrame([("a　B", "x"), ("C", "new"), ("e", "1"), ("E ", "2"), (None, "n")], "name string, nature string")
    assert rows(match.fill_by_name(table, ref, "name", "nature")) == [("A b", "x", "filled"), ("c", "old", "kept"), ("d", None, "missing"), ("e", None, "duplicate"), (None, None, "missing")]


def test_reconcile(spark):
    a = spark.createDataFrame([("k", Decimal("1.10")), ("k", Decimal("2.00")), ("l", Decimal("1.00")), ("m", Decimal("1"))], "k string, v decimal(18,2)")
    b = spark.createDataFrame([("k", Decimal("-3.10")), ("l", Decimal("-1.01")), ("n", Decimal("1"))], "k string, v decimal(18,2)")
    by = {r.k: r.status for r in match.reconcile(a, b, "k", "v").collect()}
    assert by == {"k": "ok", "l": "mismatch", "m": "left_only", "n": "right_only"}
    assert {r.k: r.status for r in match.reconcile(a, b, "k", "v", "0.01").collect()}["l"] == "ok"


def test_assign_pages_is_an_equi_join(spark):
    items = spark.createDataFrame([("a", 1, 3), ("none", 4, 3), ("b", 4, 4)], "item string, page_from int, page_to int")
    got = match.assign_pages(spark.createDataFrame([(i,) for i in range(1, 6)], "page int"), items)
    assert [(r.page, r.item) for r in sorted(got.collect())] == [(1, "a"), (2, "a"), (3, "a"), (4, "b")]
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_band_join_finds_all_pairs(spark):
    labels = spark.createDataFrame([("p", 1.0), ("p", 9.9)], "g string, at double")
    values = spark.createDataFrame([("p", float(i)) for i in range(13)] + [("q", 1.0)], "g string, at double")
    got = {(r.label_position, r.at) for r in match.band_join(labels, values, "at", 2.5, ["g"]).collect()}
    assert got == {(a, float(b)) for a in (1.0, 9.9) for b in range(13) if abs(a - b) <= 2.5}


def _nearest_of_all_pairs(parts, width):
    best = {}
    for label, brand, at in parts:
        for other, b, there in parts:
            if None not in (label, other, brand, b, at, there) and b == brand and other != label and abs(at - there) <= width:
                best[label] = min(best.get(label, (width + 1,)), (abs(at - there), b, other))
    return best


PARTS = "p_partkey long, p_brand string, p_retailprice double"


@pytest.mark.parametrize("many", [1, 3])
def test_nearest_in_band_equals_all_pairs(spark, many):
    """Equal positions, nulls, not-a-number, both ends of the band; with many > 1 keys that stand at several positions, also next to each other."""
    random = Random(many)
    parts = [(k // many * 7 % 300, random.choice("abc"), random.randrange(0, 900) / 4) for k in range(300)]
    parts += [(900 + k, "d", float(at)) for k, at in enumerate([0, 5, 10, 15.5, 15.5, 20, 25, -5])] + [(950, "e", 1.0), (951, None, 1.0), (952, "d", None), (None, "d", 5.0), (953, "d", float("nan")), (954, "d", float("inf"))]
    parts += [(960, "f", float(at)) for at in range(1, 1 + many)] + [(961, "f", 4.0), (962, "f", 0.5)]
    df = spark.createDataFrame(parts, PARTS)
    got = match.nearest_in_band(df.withColumnRenamed("p_partkey", "label"), df, "p_retailprice", 5.0, ["p_brand"], "label", "p_partkey")
    assert {r.label: (r.distance, r.p_brand, r.p_partkey) for r in got.collect()} == _nearest_of_all_pairs(parts, 5.0)


def test_band_match_makes_no_pairs(spark, tmp_path, monkeypatch):
    """40,000 parts at one price would be 1.6 billion pairs."""
    monkeypatch.setattr(match, "band_join", None)
    spark.range(40_000).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit(7.5).alias("p_retailprice")).write.parquet(str(tmp_path / "part.parquet"))
    got = catalog.QUERIES["band_match"](spark, str(tmp_path)).groupBy("p_partkey").count().collect()
    assert {r.p_partkey: r["count"] for r in got} == {0: 39_999, 1: 1}


def test_conflicts_blank_the_value(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", None)], "n string, v string")
    assert rows(match.conflicts(df, ["n"], "v")) == [("a", 1, "1", False), ("b", 2, None, True), ("c", 0, None, False)]


def test_same_batch_ties_blanks(spark):
    a = spark.createDataFrame([("p", None), ("q", 1)], "person string, no int")
    assert rows(match.same_batch(a, spark.createDataFrame([("p", None)], "person string, no int"), ["person", "no"])) == [("p", None)]


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_have_no_gaps_however_rows_are_dealt(spark, parts):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("k")).repartition(parts)
    got = sorted((r.k, r.serial, r.sheet_row) for r in number.serial(df, ["k"]).collect())
    assert got == [(k, k + 23, k + 3) for k in range(200)]
    pages = sorted((r.k, r.page_no, r.line_no) for r in number.paginate(df, ["k"]).collect())
    assert pages == [(k, k // 23 + 1, k % 23 + 1) for k in range(200)]


def test_page_ranges_within_a_batch(spark):
    df = spark.createDataFrame([("x", 1, 2), ("x", 2, 0), ("x", 3, 4), ("y", 1, 1)], "b string, o int, pages long")
    got = sorted((r.b, r.o, r.page_from, r.page_to) for r in number.page_ranges(df, ["o"], "pages", ["b"]).collect())
    assert got == [("x", 1, 1, 2), ("x", 2, 3, 2), ("x", 3, 3, 6), ("y", 1, 1, 1)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k string, v string")
    assert match.cardinality_join(none, none, "k", ["v"]).count() == 0
    assert number.serial(none, ["k"]).count() == 0
    assert check.gate(check.findings(none, F.lit(True), F.col("k"), "c", "r", "s"), Policy.ALL_PASS) == 0


def test_gate_policies(spark):
    df = spark.createDataFrame([("a",)], "k string")
    warn = check.findings(df, F.lit(True), F.col("k"), "c", "r", "s", "warn")
    error = check.findings(df, F.lit(True), F.col("k"), "c", "r", "s")
    assert check.gate(warn, Policy.ABORT) == 1
    assert check.gate(error, Policy.FLAG) == 1
    for found, policy in ((error, Policy.ABORT), (warn, Policy.ALL_PASS)):
        with pytest.raises(GateError):
            check.gate(found, policy)


def test_composition(spark):
    df = spark.createDataFrame([("a", "1.1", "3"), ("a", "1.9", "3"), ("b", "1", "2"), ("c", None, "1"), ("d", "-1", "-1")], "k string, p string, t string")
    assert {r.k: r.status for r in check.composition(df, ["k"], "p", "t").collect()} == {"a": "ok", "b": "mismatch", "c": "incomplete", "d": "ok"}


def test_file_checks(spark):
    df = spark.createDataFrame([("a1.pdf", "pdf", "h"), ("b2.pdf", "pdf", "h"), ("b2.pdf", "pdf", "i"), ("c 副本.pdf", "pdf", "j"), ("d4.exe", "exe", "k")], "name string, ext string, sha256 string")
    got = {(r.code, r.entity) for r in check.file_checks(df, r"^[a-z][0-9]\.[a-z]+$", "副本", ["pdf"]).collect()}
    assert got == {("duplicate_content", "h"), ("duplicate_name", "b2.pdf"), ("copy", "c 副本.pdf"), ("name_format", "c 副本.pdf"), ("extension", "d4.exe")}


def test_coverage_and_missing(spark):
    df = spark.createDataFrame([("u", 1), ("u", 2), ("v", 1), ("v", 9), ("w", None)], "k string, q int")
    got = {r.k: (r.n_items, r.complete, r.outside) for r in check.coverage(df, ["k"], "q", [1, 2]).collect()}
    assert got == {"u": (2, True, []), "v": (1, False, [9]), "w": (0, False, [])}
    assert check.all_pass(df, ["k"], F.col("q") > 0).filter("passed").count() == 2


CELLS = [("f", "S", 14, 3, "scope"), ("f", "S", 8, 3, "Q"), ("f", "S", 15, 1, "Ann"), ("f", "S", 15, 2, "1"), ("f", "S", 17, 1, "Bob"), ("f", "T", 14, 3, " ")]


def test_positions_and_row_blocks(spark):
    cells = spark.createDataFrame(CELLS, "path string, sheet string, row int, col int, raw string")
    rules = extract.position_rules(spark, [("kyc", "scope", None, 14, 3), ("kyc", "qual", "S", 8, 3)])
    got = sorted(((r.field, r.source.sheet, r.source.ref, r.value) for r in extract.pick_cells(cells, rules).collect()))
    assert got == [("qual", "S", "C8", "Q"), ("scope", "S", "C14", "scope"), ("scope", "T", "C14", None)]
    people = extract.row_block(cells.filter("sheet = 'S'"), 15, {1: "name", 2: "phone"})
    assert rows(people.select("row", "name", "phone")) == [(15, "Ann", "1"), (17, "Bob", None)]


def test_readings(spark):
    df = spark.createDataFrame([("k", None, 0), ("k", "b", 2), ("k", "a", 1)], "k string, v string, rank int")
    assert rows(extract.best_reading(df, ["k"], "v", "rank")) == [("k", "a", 1)]
    pair = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x string, y string")
    assert [r[0] for r in pair.select(extract.agreement(F.col("x"), F.col("y"))).collect()] == ["agree", "differ", "one_only", "missing"]


def paragraphs(spark, change=None):
    text = {q: f"{q}. question A" for q in range(1, 21)} | {13: "13. several AC", 17: "17、several BD"} | (change or {})
    return spark.createDataFrame([("f", q, t) for q, t in text.items() if t], "path string, para_no int, text string")


def test_questionnaire(spark):
    answers = score.read_answers(paragraphs(spark))
    assert score.answer_findings(answers).count() == 0
    points = spark.createDataFrame([(q, c, p) for q in range(1, 21) for c, p in zip("ABCDE", (1, 2, 3, 4, 5))], "q int, choice string, points int")
    got = score.score(answers, points, [20, 25, 28, 40], ["path"]).first()
    assert (got.score, got.level) == (18 + 4 + 6, "C4")
    assert score.answer_sheet(answers, ["path"]).first().q13 == "AC"


@pytest.mark.parametrize("change,code", [({5: None}, "question_count"), ({5: "5. AB"}, "answer_double"), ({5: "5. Z"}, "answer_invalid"), ({5: "5. ticked √"}, "answer_missing")])
def test_questionnaire_defects(spark, change, code):
    assert [r.code for r in score.answer_findings(score.read_answers(paragraphs(spark, change))).collect()] == [code]


def test_unknown_points_abort(spark):
    with pytest.raises(GateError):
        score.score(score.read_answers(paragraphs(spark)), spark.createDataFrame([(1, "A", 1)], "q int, choice string, points int"), [1, 2, 3, 4], ["path"])


def test_page_assign_reaches_the_last_page(spark, tmp_path):
    spark.range(1, 4).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), (F.col("id") * 1_800_000).alias("n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.page_assign(spark, str(tmp_path)).groupBy("doc_id").agg(F.count("*").alias("n"), F.max("page").alias("last")).collect()
    assert sorted(map(tuple, got)) == [(1, 1000, 1000), (2, 2000, 3000), (3, 3000, 6000)]


def test_ordered_lookup_tells_of_a_double_key(spark):
    import pytest
    from folioflow.operators import match

    left = spark.createDataFrame([(1, "a"), (2, "b")], "ordinal int, k string")
    right = spark.createDataFrame([("a", 5), ("c", 6), ("c", 7)], "k string, v int")
    got = match.ordered_lookup(left, right, "k", ["v"]).orderBy("ordinal").collect()
    assert [tuple(r) for r in got] == [(1, "a", 5, True), (2, "b", None, False)]
    with pytest.raises(Exception, match="not unique"):
        match.ordered_lookup(left.withColumn("k", __import__("pyspark.sql.functions").sql.functions.lit("c")), right, "k", ["v"]).collect()
