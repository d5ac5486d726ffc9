import random

import pytest
from pyspark.sql import functions as F

from folioflow import catalog_desks, staging
from folioflow.operators import extract, merge, number, readings, region, scan, templates, tokens

TOKEN = "path string, page_no int, token_no int, text string, x0 double, y0 double, x1 double, y1 double"


@pytest.fixture()
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("within", [None, ["g"]])
def test_carried_against_a_loop(spark, many_parts, within):
    r = random.Random(1)
    rows = [(r.choice(["a", "a", "a", "b", None]), k, r.choice([None, None, None, f"v{k}"]), r.choice([None, k])) for k in range(600)]
    got = number.carried(spark.createDataFrame(rows, "g string, k int, v string, w int"), ["k"], {"x": F.col("v"), "y": F.col("w")}, within)
    held, want = {}, []
    for g, k, v, w in sorted(rows, key=lambda t: (t[0] is not None, t[0] or "", t[1]) if within else t[1]):
        before = held.get(g if within else 0, (None, None))
        now = (v if v is not None else before[0], w if w is not None else before[1])
        held[g if within else 0] = now
        want.append((g, k, v, w, now[0], now[1], *before))
    assert sorted(map(tuple, got.select("g", "k", "v", "w", "x", "y", "x_before", "y_before").collect()), key=lambda t: t[1]) == sorted(want, key=lambda t: t[1])


def test_carried_over_parts_without_a_value(spark, many_parts):
    rows = spark.range(1000).select(F.lit("one").alias("g"), "id")
    got = number.carried(rows, ["id"], {"u": F.when(F.col("id") == 3, "unit")}, ["g"])
    assert got.filter("u = 'unit'").count() == 997 and got.filter("u_before = 'unit'").count() == 996
    assert number.carried(rows.limit(0), ["id"], {"u": F.lit("x")}).count() == 0


def test_rank_within(spark, many_parts):
    r = random.Random(2)
    rows = [(r.choice(["a", "a", "b", None]), k) for k in range(200)]
    got = number.rank_within(spark.createDataFrame(rows, "g string, k int"), ["g"], ["k"], "n").collect()
    assert all(x.n == sum(g == x.g and k <= x.k for g, k in rows) for x in got) and len(got) == 200


def test_pages_are_turned_upright(spark):
    upright = [("d", 1, 1, "a", 10.0, 20.0, 110.0, 40.0), ("d", 1, 2, "b", 500.0, 300.0, 560.0, 330.0)]
    w, h = 600.0, 400.0
    turned = {
        0: lambda u0, v0, u1, v1: (u0, v0, u1, v1), 90: lambda u0, v0, u1, v1: (h - v1, u0, h - v0, u1),
        180: lambda u0, v0, u1, v1: (w - u1, h - v1, w - u0, h - v0), 270: lambda u0, v0, u1, v1: (v0, w - u1, v1, w - u0),
    }
    for turn, at in turned.items():
        scanned = [(*t[:4], *at(*t[4:])) for t in upright]
        size = (w, h) if turn % 180 == 0 else (h, w)
        pages = spark.createDataFrame([("d", 1, turn - 360 if turn == 90 else turn, *size)], "path string, page_no int, rotation int, width double, height double")
        got = tokens.upright(spark.createDataFrame(scanned, TOKEN), pages).orderBy("token_no").collect()
        assert [tuple(r) for r in got] == upright
    lost = tokens.upright(spark.createDataFrame(upright, TOKEN), pages.filter("false"))
    assert sorted(map(tuple, lost.collect())) == sorted(upright)


def test_crossing_takes_the_nearest_in_row_and_column(spark):
    page = [
        (1, "total assets", 0, 100, 90, 112), (2, "2023", 300, 10, 380, 22), (3, "2022", 400, 10, 480, 22),
        (4, "1,200", 310, 103, 370, 115), (5, "900", 405, 98, 470, 110), (6, "7", 200, 101, 230, 113), (7, "55", 320, 140, 360, 152),
        (8, "total assets", 0, 200, 90, 212), (9, "31", 370, 203, 450, 215), (10, "32", 300, 204, 345, 216), (11, "no", 250, 200, 290, 212),
    ]
    df = spark.createDataFrame([("d", p, *t[:2], *map(float, t[2:])) for p in (1, 2) for t in page], TOKEN)
    for band, crowd in ((7.0, 0), (20.0, 0), (500.0, 0), (20.0, 100)):
        got = tokens.crossing_values(df, {"assets": "assets$"}, {"now": "^2023$", "before": "^2022$"}, "^[0-9,]+$", band, crowd=crowd)
        assert sorted((r.page_no, r.label_no, r.heading, r.value) for r in got.collect()) == sorted(
            (p, *x) for p in (1, 2) for x in ((1, "now", "1,200"), (1, "before", "900"), (8, "now", "32"), (8, "before", "31"))
        )


def test_units_hold_across_pages(spark):
    rows = [("d", 1, 1, "unit: 10k"), ("d", 1, 2, "5"), ("d", 3, 1, "6"), ("d", 3, 2, "unit: yuan"), ("d", 4, 9, "7"), ("e", 1, 1, "8")]
    df = spark.createDataFrame([(*t, 0.0, 0.0, 1.0, 1.0) for t in rows], TOKEN)
    got = {(r.path, r.text): r.unit for r in tokens.unit_in_force(df, "unit: (.*)").collect()}
    assert got[("d", "5")] == got[("d", "6")] == "10k" and got[("d", "7")] == "yuan" and got[("e", "8")] is None


LABELS, HEADINGS = {"assets": "assets$"}, {"now": "^2023$", "before": "^2022$"}


@pytest.mark.parametrize("crowd", [tokens.CROWD, 0])
def test_units_of_statement_fields_against_a_loop(spark, many_parts, monkeypatch, crowd):
    """Units before, between and after a page's values, on pages before, and at the value itself."""
    monkeypatch.setattr(tokens, "CROWD", crowd)
    r, rows, pages = random.Random(3), [], []
    for path in ("d", "e"):
        for page in range(1, 13):
            spots = [("2023", 300, 10), ("2022", 400, 10)]
            for y in (100, 200, 300):
                spots += [("total assets", 0, y), (r.choice(["12", "5 bn", "7"]), 310, y), (r.choice(["x", "9"]), 410, y)]
            no = 0
            for text, x, y in spots:
                if r.random() < 0.08:
                    no += 1
                    rows.append((path, page, no, r.choice(["8 k", "8 bn"]), 900.0, y + 1.0, 950.0, y + 13.0))
                no += 1
                rows.append((path, page, no, text, x + 1.0, float(y), x + 80.0, y + 12.0))
            pages.append((path, page, 0, 1000.0, 500.0))
    given = spark.createDataFrame(pages, "path string, page_no int, rotation int, width double, height double")
    got = tokens.statement_fields(spark.createDataFrame(rows, TOKEN).repartition(5), given, LABELS, HEADINGS, "^[0-9]+( bn)?$", "(k|bn)$", {"k": 1000}, 20.0).collect()
    unit, held = {}, {}
    for path, page, no, text, *_ in rows:
        held[path] = text.split()[1] if text.endswith((" k", " bn")) else held.get(path)
        unit[path, page, no] = held[path]
    assert len(got) > 80 and len({x.unit for x in got}) == 3
    for x in got:
        assert x.unit == unit[x.path, x.page_no, x.value_no] and x.amount == (int(x.value) * 1000 if x.unit == "k" and x.value.isdigit() else None)


def test_a_token_is_looked_at_once(spark):
    """What makes a token's text (a recognition, say) is worked out once for each, however many patterns and readers there are."""
    page = [("total assets", 0, 100), ("2023", 300, 10), ("2022", 400, 10), ("1,200", 310, 100), ("900", 410, 100), ("unit: k", 600, 100), ("word", 700, 100)]
    df = spark.createDataFrame([("d", p, k, t, float(x), float(y), x + 80.0, y + 12.0) for p in (1, 2) for k, (t, x, y) in enumerate(page)], TOKEN)
    pages = spark.createDataFrame([("d", p, 0, 1000.0, 500.0) for p in (1, 2)], "path string, page_no int, rotation int, width double, height double")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    got = tokens.statement_fields(df.withColumn("text", read("text")), pages, LABELS, HEADINGS, "^[0-9,]+$", "unit: (.*)", {"k": 1000}, 20.0).collect()
    assert sorted((x.page_no, x.heading, x.value, x.unit) for x in got) == [(1, "before", "900", None), (1, "now", "1,200", None), (2, "before", "900", "k"), (2, "now", "1,200", "k")]
    assert seen.value == df.count()


def findings(df):
    return sorted((r.code, r.entity) for r in df.collect())


def test_islands_and_borders(spark):
    read = {1: "A", 2: None, 3: None, 4: None, 5: "B", 6: "B", 8: None, 9: "C", 10: "C", 11: "C", 12: None, 13: "A"}
    rows = [("x", p, n) for p, n in read.items()] + [("x", 10, "C")] + [("y", 1, None), ("y", 2, "Z"), ("y", 3, None), ("y", 4, None), ("y", 5, None)]
    pages, found = scan.islands(spark.createDataFrame(rows, "b string, page long, read string"), ["b"], "page", "read")
    got = {(r.b, r.island): (r.number, r.n_pages, r.n_read, r.last_page, r.gaps) for r in found.collect()}
    assert got == {("x", 1): ("A", 4, 1, 4, 0), ("x", 5): ("B", 3, 2, 8, 1), ("x", 9): ("C", 5, 4, 12, 0), ("x", 13): ("A", 1, 1, 13, 0), ("y", 2): ("Z", 4, 1, 5, 0)}
    assert findings(scan.boundary_findings(pages, found, ["b"], "page", 4)) == [
        ("length", "x/13"), ("length", "x/5"), ("length", "x/9"), ("number_again", "x/A"), ("page_double", "x/10"), ("page_missing", "x/8"), ("shifted", "y/2"), ("unread", "y/1"),
    ]


def test_pages_that_are_there_twice_keep_one_order(spark, many_parts, monkeypatch):
    """A number changes on every page, and every page is there many times: none of them may fall to the island before, in
    whatever order equal pages come to the second look."""
    carried = number.carried
    monkeypatch.setattr(number, "carried", lambda rows, *rest: carried(rows.repartition(7, F.rand(1)), *rest))
    rows = spark.range(400).select((F.col("id") % 20).alias("b"), (F.floor(F.col("id") / 20) + 1).alias("page"), F.concat(F.lit("T"), F.floor(F.col("id") / 20)).alias("read"))
    _, found = scan.islands(rows.crossJoin(spark.range(5).select()), ["b"], "page", "read")
    got = found.collect()
    assert len(got) == 400 and {(r.island, r.last_page, r.n_pages, r.gaps) for r in got} == {(k, k, 5, 0) for k in range(1, 21)}


CELLS = "path string, sheet string, row int, col int, raw string"


def test_header_place_and_overlay(spark):
    cells = [("p", "S", 1, 1, "Name"), ("p", "S", 3, 2, " na me"), ("p", "S", 3, 4, "Amount"), ("p", "S", 4, 2, "x"), ("p", "S", 9, 4, "5"), ("p", "S", 12, 9, "far away"), ("p", "S", 10, 4, " ")]
    cells += [("q", "S", 1, 1, "name"), ("q", "S", 5, 1, "name"), ("r", "S", 1, 1, "nothing")]
    df = spark.createDataFrame(cells, CELLS)
    headers = region.next_rows(df, region.find_headers(df, {"who": "Name", "sum": "amount"}))
    got = {r.path: (r.header_row, r.n_names, r.n_ties, r.columns, r.next_row) for r in headers.collect()}
    assert got == {"p": (3, 2, 0, {"who": 2, "sum": 4}, 10), "q": (1, 1, 1, {"who": 1}, 6)}
    planned = [("p", "S", None, 1, "who", "new"), ("p", "S", None, 2, "sum", "8"), ("p", "S", 9, 1, "sum", "6"), ("p", "S", 4, 1, "who", "x"), ("p", "S", 4, 1, "sum", " "), ("p", "S", 4, 1, "age", "1"), ("q", "S", None, 1, "who", "n"), ("r", "S", None, 1, "who", "n")]
    writes, lost = region.placed(spark.createDataFrame(planned, "path string, sheet string, row int, ordinal int, field string, value string"), headers)
    assert findings(lost) == [("header_tie", "q:S"), ("no_column", "p:S:age"), ("no_header", "r:S:who")]
    for update, state, value in ((False, "occupied", "5"), (True, "updated", "6")):
        grid, found = region.overlay(df, writes, update)
        got = {(r.row, r.col): (r.value, r.state) for r in grid.filter("path = 'p'").collect()}
        assert got[(9, 4)] == (value, state) and got[(10, 2)] == ("new", "written") and got[(11, 4)] == ("8", "written") and got[(4, 2)] == ("x", "same") and got[(12, 9)] == ("far away", "kept")
        assert (10, 4) not in got and findings(found) == ([] if update else [("occupied", "p:S:9:4")])
    twice = spark.createDataFrame([("p", "S", 20, 1, "f", "b"), ("p", "S", 20, 1, "f", "a")], "path string, sheet string, row int, col int, field string, value string")
    grid, found = region.overlay(df, twice)
    assert [r.value for r in grid.filter("row = 20").collect()] == ["a"] and findings(found) == [("planned_twice", "p:S:20:1")]


def test_persons_over_three_documents(spark):
    schema = "case_id string, name string, id_no string, phone string"
    first = spark.createDataFrame([("c", "Ann Lee", "1", None), ("c", "Bob", "2", "7"), (None, "Zoe", "9", None), ("c", " ", "9", None)], schema)
    second = spark.createDataFrame([("c", "ann lee", "1", "5"), ("c", "bob", "3", "8"), ("d", "Ann Lee", None, " ")], schema)
    third = spark.createDataFrame([("c", "ANNLEE", "6")], "case_id string, name string, phone string")
    out, found = merge.merge_sources({"form": first, "scan": second, "mail": third}, ["case_id"], "name", ["id_no", "phone"], ["phone"])
    got = {(r.case_id, r.name): (r.n_sources, r.id_no, r.id_no_source, r.id_no_status, r.phone, r.phone_source, r.phone_status) for r in out.collect()}
    assert got == {
        ("c", "Ann Lee"): (3, "1", "form", "agreed", "5", "scan", "ranked"),
        ("c", "Bob"): (2, None, None, "conflict", "7", "form", "ranked"),
        ("d", "Ann Lee"): (1, None, None, "missing", None, None, "missing"),
    }
    assert findings(found) == [("id_no_conflict", "c/Bob"), ("no_name", "c/form"), ("no_name", "form"), ("phone_ranked", "c/Ann Lee"), ("phone_ranked", "c/Bob")]


def test_best_template_of_each_sheet(spark):
    anchors = spark.createDataFrame([("old", 1, 1, "Form"), ("new", 1, 1, "form"), ("new", 2, 1, "Edition 2"), ("odd", 5, 5, "x"), ("even", 5, 5, "X")], "template string, row int, col int, text string")
    cells = [("a", "S", 1, 1, "FORM"), ("a", "S", 3, 3, "va"), ("b", "S", 1, 1, "Form"), ("b", "S", 2, 1, "edition2"), ("b", "S", 4, 4, "vb"), ("c", "S", 2, 1, "Edition 2"), ("d", "S", 5, 5, "x"), ("e", "S", 9, 9, "?"), ("b", "T", 1, 1, "form"), ("b", "T", 3, 3, " ")]
    rules = spark.createDataFrame([("old", "v", None, 3, 3), ("new", "v", "S", 4, 4)], "template string, field string, sheet string, row int, col int")
    out, found = templates.fields(spark.createDataFrame(cells, CELLS), anchors, rules)
    assert sorted((r.path, r.sheet, r.template, r.value, r.source.ref) for r in out.collect()) == [("a", "S", "old", "va", "C3"), ("b", "S", "new", "vb", "D4")]
    assert sorted((r.code, r.entity, r.reason) for r in found.collect()) == [("no_template", "c:S", "nearest: new with 1 anchors"), ("no_template", "e:S", "nothing fits"), ("template_tie", "d:S", "2 versions fit as well")]


def test_positions_that_all_sheets_share_shuffle_no_cells(spark):
    """A rule's cell is that of every sheet: dealt by position, one task would get them all."""
    cells, rules = spark.createDataFrame([("a", "S", 1, 1, "x")], CELLS), extract.position_rules(spark, [("t", "f", None, 1, 1)])
    assert "Exchange hashpartitioning" not in extract.pick_cells(cells, rules)._jdf.queryExecution().executedPlan().toString()
    anchors = spark.createDataFrame([("t", 1, 1, "X"), ("u", 1, 1, "x"), ("u", 2, 2, "y")], "template string, row int, col int, text string")
    plan = templates.choose(cells, anchors)[0]._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(path" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line for line in dealt)


def test_lines_are_put_together_once_and_cells_made_once(spark):
    """Labels, headings and values read the lines as staged; no cells are made first to test the size of their array."""
    plan = catalog_desks.crossing_values(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "size(" not in plan and "lambda" not in plan


def test_spread_parts_are_not_put_together(spark):
    got = staging.spread(spark.range(8), "id").groupBy("id").count()
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_readings_by_rules_in_order_of_trust(spark):
    rules = [
        readings.Rule("price", "price: ([0-9,.]+)", 1, "decimal"), readings.Rule("price", "at ([0-9,.]+)", 2, "decimal"), readings.Rule("day", "on ([0-9./-]+)", 1, "date"),
        readings.Rule("no", "no (T[0-9]+)"), readings.Rule("clause", "clause (\\w+)", many=True),
    ]
    pages = [
        ("a", 1, "no T1 at 9 on 2024/2/3"), ("a", 2, "price: 1,200.50 no T1 clause z clause b"), ("a", 3, "clause b clause y"), ("a", 3, "clause b clause y"),
        ("b", 1, "no T1"), ("b", 2, "no T2 price: .,. at 7 on 2024.13.1"), ("c", 1, None),
    ]
    out, found = readings.read(spark.createDataFrame(pages, "path string, page_no int, text string"), rules)
    got = {(r.path, r.field): (r.value, r.page_no, r.rank, r.n_values, r.status) for r in out.collect()}
    assert got[("a", "price")] == ("1200.500000", 2, 1, 1, "ok") and got[("a", "day")] == ("2024-02-03", 1, 1, 1, "ok") and got[("a", "no")] == ("T1", 1, 1, 1, "ok")
    assert got[("a", "clause")] == ("b;z;y", 2, 1, 3, "list")
    assert got[("b", "price")] == ("7.000000", 2, 2, 1, "ok")  # the trusted rule's find is no number
    assert got[("b", "day")] == (None, None, None, 0, "invalid") and got[("b", "no")] == (None, None, 1, 2, "ambiguous")
    assert {got[("c", f)][4] for f in ("price", "day", "no", "clause")} == {"missing"} and len(got) == 12
    assert findings(found) == [("reading", x) for x in ("b:clause", "b:day", "b:no", "c:clause", "c:day", "c:no", "c:price")]
