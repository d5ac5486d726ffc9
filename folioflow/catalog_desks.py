"""Queries that show sources, sinks and whole workflows over the test tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import check, extract, match, number, score
from .plans import desks
from .sinks import deliver, print_files
from .sinks.workbook import workbooks
from .sources import office, places, seams
from .staging import spread, staged


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _money(c: str):
    return F.col(c).cast("decimal(18,2)")


# settlement


def _settlement(spark, sf):
    o = _t(spark, sf, "orders")
    key = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderkey"))
    c = o.select(F.col("o_orderkey").alias("ordinal"), key.alias("contract"), _money("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("direction"), "o_orderpriority")
    off = F.when(F.col("ordinal") % 97 == 0, F.lit("0.01")).otherwise(F.lit("0")).cast("decimal(18,2)")
    c = c.withColumn("company_amount", (X.flipped(F.col("amount"), F.col("direction"), ["F"]) + off).cast("decimal(18,2)"))
    export = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("contract"), "l_partkey")
    return desks.settlement(c, export, "contract", ["l_partkey"], "amount", "direction", ["F"], ["o_orderpriority", "amount"])


def settlement_old(spark, sf):
    return _settlement(spark, sf)[0].select("ordinal", "contract", "l_partkey", "match_status")


def settlement_new(spark, sf):
    return _settlement(spark, sf)[1].select("ordinal", "contract", F.col("customer_amount").cast("double").alias("customer_amount"))


def settlement_findings(spark, sf):
    return check.summary(_settlement(spark, sf)[2])


def settlement_texts(spark, sf):
    """Amounts as they stand in a workbook's cells: some are no numbers, some blank; the stated total is off by a hundredth."""
    o, k = _t(spark, sf, "orders"), F.col("o_orderkey")
    text = F.when(k % 53 == 0, "n/a").when(k % 59 == 0, " ").otherwise(_money("o_totalprice").cast("string"))
    c = o.select(k.alias("ordinal"), k.alias("contract"), text.alias("amount"), F.col("o_orderstatus").alias("direction"), _money("o_totalprice").cast("string").alias("company_amount"))
    c = c.withColumn("company_amount", X.flipped(F.col("company_amount").try_cast("decimal(18,2)"), F.col("direction"), ["F"]).cast("string"))
    total = "0.01"
    export = _t(spark, sf, "orders").select(k.alias("contract"), "o_custkey")
    return desks.settlement(c, export, "contract", ["o_custkey"], "amount", "direction", ["F"], ["company_amount"], stated=F.lit(total))[2].select("entity", "code", "reason")


# policy, compliance, register, statistics


def _policies(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", _money("o_totalprice").alias("total"))
    own = (F.col("total") - F.lit("10.00").cast("decimal(18,2)")).cast("decimal(18,2)")
    o = o.withColumns({"own_funds": own, "loan": F.when(F.col("o_orderkey") % 5 == 0, F.lit("10.01")).when(F.col("o_orderkey") % 5 != 1, F.lit("10.00")).cast("decimal(18,2)")})
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    return desks.policy_fill(o, li, "o_orderkey", ["l_suppkey"], "total", ["own_funds", "loan"])


def policy_table(spark, sf):
    return _policies(spark, sf)[0].select("o_orderkey", "l_suppkey", "match_status")


def policy_findings(spark, sf):
    return _policies(spark, sf)[1].select("entity", "code", "reason", "severity")


def compliance_findings(spark, sf):
    c = _t(spark, sf, "customer")
    table = c.select("c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("nature"))
    ref = c.filter("c_custkey % 5 <> 0").select(F.upper("c_name").alias("name"), F.col("c_mktsegment").alias("nature"))
    return desks.compliance_fill(table, ref)[1].select("entity", "code", "reason", "severity")


def _register(spark, sf):
    e = _t(spark, sf, "events").select(F.col("user_id").cast("string").alias("case_id"), F.col("event_type").alias("field"), F.col("event_id").alias("value"))
    k = F.col("c_custkey")
    c = _t(spark, sf, "customer").select(
        (k % 50).cast("string").alias("case_id"), "c_custkey", F.col("c_mktsegment").alias("name"),
        F.concat(F.lpad(k.cast("string"), 17, "1"), F.lit("X")).alias("id_no"), F.when(k % 3 != 0, F.col("c_name")).alias("phone"),
    )
    return desks.register(e, c, ["click", "view"], ["name", "phone"])


def register_cases(spark, sf):
    return _register(spark, sf)[0]


def register_persons(spark, sf):
    return _register(spark, sf)[1].select("case_id", "c_custkey", "name", "id_no", "id_ok", F.array_join("missing", ",").alias("missing"))


def register_findings(spark, sf):
    return check.summary(_register(spark, sf)[2])


def statement_figures(spark, sf):
    k = F.col("c_custkey")
    c = _t(spark, sf, "customer").select(k, _money("c_acctbal").alias("assets"), (k % 100 * 10).cast("decimal(18,2)").alias("liabilities"), (k % 7).cast("decimal(18,2)").alias("profit"), F.when(k % 2 == 0, "yuan").otherwise("ten_thousand").alias("unit"))
    out = desks.statement_figures(c, {"yuan": 1, "ten_thousand": 10000})
    return out.select("c_custkey", *(F.col(n).cast("double").alias(n) for n in ("assets", "liabilities", "profit", "net_assets")), "debt_ratio")


def crossing_values(spark, sf):
    """Each order as a sheet: headings in row 1, line numbers down column 1, quantities and discounts where they cross."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")  # latest carries all that it gets
    head = F.expr("array(struct(1 as row, 1 as col, 'line' as raw), struct(1 as row, 2 as col, 'quantity' as raw), struct(1 as row, 3 as col, 'supplier' as raw))")
    line = F.expr("array(struct(cast(l_linenumber + 1 as int) as row, 1 as col, concat('no. ', l_linenumber) as raw), struct(cast(l_linenumber + 1 as int) as row, 2 as col, cast(cast(l_quantity as int) as string) as raw), struct(cast(l_linenumber + 1 as int) as row, 3 as col, cast(l_suppkey as string) as raw))")
    one = staged(number.latest(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"), "lines")  # six readers
    own = [F.col("l_orderkey").cast("string").alias("path"), F.lit("S").alias("sheet")]
    # each branch explodes what it makes: arrays that pass a union are made to test their size, and made again
    cells = one.select(*own, F.explode(line).alias("c")).unionByName(one.select("l_orderkey").distinct().select(*own, F.explode(head).alias("c"))).select("path", "sheet", "c.*")
    return extract.crossing(cells, {"first": "^no. 1$", "second": "^no. 2$"}, {"quantity": "^quantity$", "supplier": "^supplier$"}).select("path", "label", "heading", "value")


def occupied_findings(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "source")
    return desks.write_region(d, _t(spark, sf, "labels"), ["doc_id"], "quality").select("entity", "code", "severity")


def next_free_row(spark, sf):
    d = _t(spark, sf, "documents").select("source", F.col("doc_id").alias("row"), F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("held"))
    return desks.next_free_row(d, ["source"], "held")


# trading


def _items(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_custkey", F.col("o_orderkey").alias("ordinal"), F.col("o_orderpriority").alias("name"), (F.col("o_orderkey") % 4 + 1).alias("pages"))


def _scan(items, profile):
    plan = desks.merge_plan(items, profile, ["o_custkey"])
    last = plan.groupBy("o_custkey").agg(F.sum("pages").alias("n"))
    return last.select("o_custkey", F.explode(F.expr("sequence(1L, n + if(o_custkey % 3 = 0, 1, 0))")).alias("page"))


def merge_plan(spark, sf):
    return desks.merge_plan(_items(spark, sf), desks.PROFILES["option_confirmation"], ["o_custkey"]).select("o_custkey", "ordinal", "pages", "page_from", "page_to")


def split_plan(spark, sf):
    items, profile = _items(spark, sf), desks.PROFILES["option_confirmation"]
    return desks.split_plan(_scan(items, profile), items, profile, ["o_custkey"])[0].select("o_custkey", "page", "ordinal", "name", "item_page")


def split_findings(spark, sf):
    items, profile = _items(spark, sf), desks.PROFILES["option_confirmation"]
    return check.summary(desks.split_plan(_scan(items, profile), items, profile, ["o_custkey"])[1])


def _batches(spark, sf):
    o = _t(spark, sf, "orders")
    item = F.struct(F.col("o_orderkey").cast("int").alias("ordinal"), F.col("o_orderkey").cast("string").alias("name"), F.sha2("o_orderpriority", 256).alias("sha256"))
    batches = o.groupBy(F.col("o_custkey").cast("string").alias("batch_id")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    k = F.col("o_orderkey")
    there = o.filter("o_orderkey % 11 <> 0").unionByName(o.filter("o_orderkey % 13 = 0").withColumn("o_orderkey", -1 - k))
    material = there.select(F.col("o_custkey").cast("string").alias("batch_id"), k.cast("string").alias("name"), F.sha2(F.when(k % 17 == 0, F.lit("x")).otherwise(F.col("o_orderpriority")), 256).alias("sha256"))
    return batches, material


def batch_findings(spark, sf):
    return places.batch_findings(*_batches(spark, sf)).select("entity", "code")


def batch_records(spark, sf):
    """Batch records as JSON, read back by their schema."""
    b = _batches(spark, sf)[0].select("batch_id", F.lit(None).cast("string").alias("person"), F.lit("k").alias("kind"), F.lit("2024-03-09").cast("date").alias("task_date"), F.lit(7).alias("batch_no"), "items")
    b = b.withColumn("items", F.transform("items", lambda i: F.struct(i["ordinal"].alias("ordinal"), i["name"].alias("name"), i["sha256"].alias("sha256"), F.lit(1).alias("pages"), F.lit(1).alias("page_from"), F.lit(1).alias("page_to"))))
    read = F.from_json("record", places.SCHEMAS["batch"], {"dateFormat": "yyyy-MM-dd"})
    return deliver.batch_record(b).select(read.alias("b")).select("b.batch_id", F.date_format("b.task_date", "yyyyMMdd").alias("task_date"), F.size("b.items").cast("long").alias("n_items"), F.array_join("b.items.name", ",").alias("names"))


def holdings_checks(spark, sf):
    return desks.holdings_checks(*_holdings(spark, sf))[0]


def holdings_findings(spark, sf):
    return desks.holdings_checks(*_holdings(spark, sf))[1].select("entity", "code")


def _holdings(spark, sf):
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("path"), F.col("l_linenumber").alias("page_no"), F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("text"))
    one = spread(li, "path", "page_no").groupBy("path", "page_no").agg(F.min("text").alias("text"))
    batch = _t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("path"), (F.col("o_orderkey") % 4 + 1).alias("pages"))
    return one, batch, "^[AR]", "F$"


def trade_numbers(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("page"), F.concat(F.lit("Trade no. T"), F.lpad(F.col("l_partkey").cast("string"), 8, "0"), F.lit(" of today")).alias("text"))
    out = extract.group_numbers(li, ["l_orderkey"], "page", 2, "T([0-9]{8})")
    return out.withColumn("name", X.business_name(F.col("number"), F.col("part_no").cast("string"), ext="pdf"))


# questionnaires


def _paragraphs(spark, sf):
    letters = F.when(F.col("turn") % 3 == 0, "A").when(F.col("turn") % 3 == 1, "CBB").otherwise("F")
    return _t(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("path"), F.concat((F.col("turn") + 1).cast("string"), F.lit(". "), F.coalesce("text", F.lit("")), F.lit(" "), letters).alias("text"))


def read_answers(spark, sf):
    return score.read_answers(_paragraphs(spark, sf)).select("path", F.col("q").cast("long").alias("q"), F.array_join("choices", "").alias("choices"))


def answer_findings(spark, sf):
    return check.summary(score.answer_findings(score.read_answers(_paragraphs(spark, sf)), questions=4, multi=(2,)))


def answers_from_sheet(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("path"), (F.col("o_orderkey") + 1).alias("row"), (F.col("o_orderkey") % 25 + 1).alias("col"), F.concat(F.lit("x "), "o_orderstatus").alias("raw"))
    return score.answers_from_sheet(o).select("path", "row", "q", F.array_join("choices", "").alias("choices"))


# cells, files, texts


def _cells(spark, sf):
    li = _t(spark, sf, "lineitem")
    one = li.select(F.col("l_orderkey").cast("string").alias("path"), F.concat(F.lit("S"), F.col("l_linenumber") % 2).alias("sheet"), F.col("l_linenumber").cast("int").alias("row"), F.expr("array(named_struct('col', 1, 'raw', l_returnflag), named_struct('col', 3, 'raw', cast(l_suppkey as string)))").alias("c"))
    return one.select("path", "sheet", "row", F.explode("c").alias("c")).select("path", "sheet", "row", "c.*")


def pick_cells(spark, sf):
    rules = extract.position_rules(spark, [("t", "flag", None, 1, 1), ("t", "supplier", "S0", 2, 3), ("t", "nothing", "S1", 2, 3)])
    return extract.pick_cells(_cells(spark, sf), rules).select("path", "field", "value", F.col("source.ref").alias("ref"))


def row_block(spark, sf):
    return extract.row_block(_cells(spark, sf), 3, {1: "flag", 3: "supplier"})


def _sheets(spark, sf):
    """Orders as small tables: a row for each line, (line number, flag, quantity)."""
    line = F.struct("l_linenumber", "l_returnflag", "l_partkey", F.array(F.col("l_linenumber").cast("string"), "l_returnflag", F.col("l_partkey").cast("string")).alias("v"))
    lines = F.transform(F.array_sort(F.collect_list(line)), lambda s: s["v"])
    return _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("path")).agg(lines.alias("lines"))


def _read_back(cells):
    return cells.select("path", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "raw")


def xlsx_cells(spark, sf):
    """A workbook for each order, written and read on the executors."""
    return _read_back(office.read_cells(workbooks(_sheets(spark, sf), "path", "lines")))


def html_cells(spark, sf):
    """The same tables as HTML under the wrong name; every table's first column spans two."""
    row = F.transform("lines", lambda r: F.concat(F.lit('<tr><td colspan="2">'), r[0], F.lit("</td><td>"), r[1], F.lit("</td><td> "), r[2], F.lit("&nbsp;</td></tr>")))
    page = F.concat(F.lit("<html><table>"), F.array_join(row, "\n"), F.lit("</table></html>"))
    return _read_back(office.read_cells(_sheets(spark, sf).select("path", page.cast("binary").alias("content"))))


def _trade_files(spark, sf):
    """A PDF for each order, a page for each of its first lines: as many as the order's number says."""
    o = _t(spark, sf, "orders").repartition(spark.sparkContext.defaultParallelism)  # a file is far larger than its row
    page = F.transform(F.expr("sequence(1, cast(o_orderkey % 3 as int) + 1)"), lambda k: F.concat(F.lit("Trade no. T"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit("\nprice "), F.col("o_totalprice").cast("string"), F.lit("\npage "), k.cast("string")))
    return o.select("o_custkey", "o_orderkey", F.size(page).alias("pages"), page.alias("texts"))


def pdf_fields(spark, sf):
    """Confirmations as PDFs, read back: one row a page, fields by patterns."""
    files = print_files.text_files(_trade_files(spark, sf), "o_orderkey", "texts")
    out = extract.text_fields(seams.read_text_pdfs(files), {"trade": "T([0-9]{8})", "own_page": "page ([0-9]+)"})
    return out.select("path", F.col("page_no").cast("long").alias("page_no"), "trade", "own_page")


def pdf_merged(spark, sf):
    """Each customer's PDFs merged in order, padded to even page counts; the pages of the merged files."""
    files = print_files.text_files(_trade_files(spark, sf), "o_orderkey", "texts", ["o_custkey", "o_orderkey"])
    pages = seams.read_text_pdfs(print_files.merged(files, "o_custkey", "o_orderkey", even=True).withColumnRenamed("o_custkey", "path"))
    return pages.select(F.col("path").alias("batch"), F.col("page_no").cast("long").alias("page_no"), "has_text", X.captured(F.col("text"), "T([0-9]{8})").alias("trade"))


def material(spark, sf):
    p = _t(spark, sf, "pages").select(F.concat(F.lit("/in/"), (F.col("page_id") % 100).cast("string"), F.lit("/p"), F.col("page_id").cast("string"), F.lit(".HTML")).alias("path"), F.length("html").cast("long").alias("length"), F.col("html").cast("binary").alias("content"))
    return places.with_batch(office.material(p, "run")).select("run_id", "case_id", "path", "name", "ext", "sha256", "length", F.col("batch_no").cast("long").alias("batch_no"))


def pending_lines(spark, sf):
    li = _t(spark, sf, "lineitem")
    return deliver.pending_lines(check.findings(li, F.col("l_quantity") > 45, F.col("l_orderkey"), "quantity", "too many", "demo", "warn"))


def source_records(spark, sf):
    c = _t(spark, sf, "customer").select((F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("string").alias("case_id"), "c_custkey", "c_name", "c_mktsegment")
    long = extract.unpivot_fields(c, ["case_id", "c_custkey"], ["c_mktsegment", "c_name"])
    f = long.select("case_id", F.lit("e").alias("entity"), F.col("c_custkey").cast("int").alias("ordinal"), "field", "value", F.lit(None).cast("struct<path:string>").alias("source"), F.lit("rule").alias("basis"), F.lit("ok").alias("status"))
    return deliver.source_records(f)


def text_functions(spark, sf):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    span = X.period(F.concat(F.lit("from "), F.date_format(d, "yyyy/M/d"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" to "), F.date_format(F.date_add(d.cast("date"), 30), "yyyy-MM-dd")))))
    mark = F.when(k % 4 == 0, " 　").otherwise(F.col("o_orderpriority"))
    return _t(spark, sf, "orders").select(
        "o_orderkey", span["start"].cast("string").alias("start"), span["end"].cast("string").alias("end"), span["open_ended"].alias("open_ended"),
        X.flipped(F.col("o_totalprice"), F.col("o_orderstatus"), ["O"]).alias("signed"), X.blank_to_null(mark).alias("mark"),
        X.business_name(F.col("o_orderstatus"), X.blank_to_null(mark), F.date_format(d, "MMdd"), ext="pdf").alias("file"),
        X.month_day(F.date_format(d, "MMdd"), 2023).cast("string").alias("day"), F.array_join(X.answer_letters(F.concat(F.lit("answer: "), F.col("o_orderstatus"), F.lit("CAA "))), "").alias("letters"),
    )


# relational


def control_total(spark, sf):
    out = check.control_total(_t(spark, sf, "lineitem"), "l_extendedprice", F.lit("12.50"))
    return out.select("n", F.col("total").cast("double").alias("total"), "n_blank", F.col("stated").cast("double").alias("stated"), "status")


def distinct_items(spark, sf):
    return _t(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()


def common_keys(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    return match.common_keys(o, _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


def top_k(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


def source_order(spark, sf):
    d = _t(spark, sf, "documents").select("source", "doc_id")
    return number.running_total(d, ["source", "doc_id"], F.lit(1).cast("long"), "ordinal").orderBy("ordinal")


def union_kinds(spark, sf):
    c = _t(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = _t(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return c.unionByName(s, allowMissingColumns=True)


_QUERIES = (
    settlement_old, settlement_new, settlement_findings, settlement_texts, policy_table, policy_findings, compliance_findings, register_cases, register_persons, register_findings,
    statement_figures, crossing_values, occupied_findings, next_free_row, merge_plan, split_plan, split_findings, batch_findings, batch_records, holdings_checks,
    holdings_findings, trade_numbers, read_answers, answer_findings, answers_from_sheet, pick_cells, row_block, xlsx_cells, html_cells, pdf_fields, pdf_merged, material, pending_lines,
    source_records, text_functions, control_total, distinct_items, common_keys, top_k, source_order, union_kinds,
)
QUERIES = {f.__name__: f for f in _QUERIES}

_SETTLEMENT = """
with c as (select o_orderkey as ordinal, case when o_orderkey % 50 <> 0 then o_orderkey end as contract,
  case when o_orderstatus = 'F' then -cast(o_totalprice as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end as amount,
  case when o_orderkey % 97 = 0 then 0.01 else 0 end as off from orders),
x as (select l_orderkey, count(*) as n, min(l_partkey) as p from lineitem group by 1)"""
_POLICY = """
with x as (select l_orderkey, count(*) as n, min(l_suppkey) as s from lineitem group by 1),
m as (select o_orderkey, case when n = 1 then s end as l_suppkey, case when n is null then 'unmatched' when n > 1 then 'duplicate' else 'matched' end as match_status
  from orders left join x on o_orderkey = l_orderkey)"""
_PERSONS = """
with c as (select cast(c_custkey % 50 as varchar) as case_id, c_custkey, c_mktsegment as name, lpad(cast(c_custkey as varchar), 17, '1') as d, c_name from customer),
k as (select *, list_sum(list_transform(range(1, 18), lambda i: cast(d[i] as bigint) * [7,9,10,5,8,4,2,1,6,3,7,9,10,5,8,4,2][i])) % 11 = 2 as id_ok from c),
n as (select case_id, name, count(distinct d) as ids from c group by 1, 2)"""
_MERGE = """
with i as (select o_custkey, o_orderkey as ordinal, o_orderpriority as name, o_orderkey % 4 + 1 as own, (o_orderkey % 4 + 2) // 2 * 2 as pages from orders),
m as (select *, cast(sum(pages) over (partition by o_custkey order by ordinal) as bigint) as page_to from i)"""
_SCAN = """,
s as (select o_custkey, cast(unnest(range(1, cast(sum(pages) as bigint) + 1 + case when o_custkey % 3 = 0 then 1 else 0 end)) as bigint) as page from m group by o_custkey)"""
_HOLDINGS = """
with p as (select l_orderkey, l_linenumber, min(l_returnflag || ' ' || l_linestatus) as text from lineitem group by 1, 2),
f as (select l_orderkey, bool_or(text[1] in ('A', 'R')) as account, arg_max(text[-1] = 'F', l_linenumber) as cash, count(*) as n from p group by 1),
h as (select cast(o_orderkey as varchar) as path, coalesce(account, false) as account, coalesce(cash, false) as cash, coalesce(n, 0) = o_orderkey % 4 + 1 as pages
  from orders left join f on o_orderkey = l_orderkey)"""
_ANSWERS = """
with a as (select cast(conv_id as varchar) as path, turn + 1 as q, case turn % 3 when 0 then 'A' when 1 then 'BC' else 'F' end as choices from conversations)"""
_LINES = """
with l as (select l_orderkey, l_returnflag, l_partkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber, l_returnflag, l_partkey) as row from lineitem)"""
_BATCH = """
with w as (select o_custkey, o_orderkey from orders), h as (select o_custkey, o_orderkey from orders where o_orderkey % 11 <> 0
  union all select o_custkey, -1 - o_orderkey from orders where o_orderkey % 13 = 0)"""

ORACLES = {
    "settlement_old": _SETTLEMENT + """ select ordinal, contract, case when n = 1 then p end as l_partkey,
  case when n is null then 'unmatched' when n > 1 then 'duplicate' else 'matched' end as match_status from c left join x on contract = l_orderkey""",
    "settlement_new": _SETTLEMENT + " select ordinal, contract, cast(amount as double) as customer_amount from c",
    "settlement_texts": """
with o as (
  select o_orderkey as k, cast(o_totalprice as decimal(18, 2)) * case when o_orderstatus = 'F' then -1 else 1 end as company,
    case when o_orderkey % 53 = 0 or o_orderkey % 59 = 0 then null else cast(o_totalprice as decimal(18, 2)) * case when o_orderstatus = 'F' then -1 else 1 end end as amount,
    o_orderkey % 53 = 0 as wrong from orders)
select cast(k as varchar) as entity, 'not_castable' as code, 'amount is no decimal(18,2): n/a' as reason from o where wrong
union all select cast(k as varchar), 'value_blank', 'amount is blank' from o where amount is null and not wrong
union all select cast(k as varchar), 'reverse_check', 'right_only' from o where amount is null
union all select 'total', 'control_total', cast(sum(amount) as varchar) || ' against 0.01, incomplete' from o""",
    "settlement_findings": _SETTLEMENT + """, f as (select 'key_blank' as code from c where contract is null union all select 'key_double' from x where n > 1
  union all select 'not_in_export' from c where contract is null or contract not in (select l_orderkey from x)
  union all select 'reverse_check' from c group by contract having sum(off) <> 0)
select 'settlement' as stage, 'error' as severity, code, count(*) as n from f group by code""",
    "policy_table": _POLICY + " select * from m",
    "policy_findings": _POLICY + """ select cast(o_orderkey as varchar) as entity, 'match' as code, match_status as reason, 'warn' as severity from m where match_status <> 'matched'
union all select cast(o_orderkey as varchar), 'composition', 'parts don''t add up to the amount', 'warn' from m where match_status = 'matched' and o_orderkey % 5 < 2""",
    "compliance_findings": """
select c_name as entity, 'nature_blank' as code, 'missing' as reason, 'warn' as severity from customer where c_custkey % 15 = 0""",
    "register_cases": """select cast(user_id as varchar) as case_id, max(case when event_type = 'click' then event_id end) as click,
  max(case when event_type = 'view' then event_id end) as view from events group by 1""",
    "register_persons": _PERSONS + """ select case_id, c_custkey, name, case when id_ok and ids = 1 then d || 'X' end as id_no, id_ok,
  case when c_custkey % 3 = 0 then 'phone' else '' end as missing from k join n using (case_id, name)""",
    "register_findings": _PERSONS + """, f as (select 'incomplete' as code from k where c_custkey % 3 = 0 union all select 'id_check' from k where not id_ok
  union all select 'conflict' from n where ids > 1) select 'register' as stage, 'warn' as severity, code, count(*) as n from f group by code""",
    "statement_figures": """
with c as (select c_custkey, case when c_custkey % 2 = 0 then 1 else 10000 end as u, cast(c_acctbal as decimal(18,2)) as a, cast(c_custkey % 100 * 10 as decimal(18,2)) as l, c_custkey % 7 as p from customer)
select c_custkey, cast(a * u as double) as assets, cast(l * u as double) as liabilities, cast(p * u as double) as profit, cast((a - l) * u as double) as net_assets,
  case when a > 0 then cast(l * u as double) / cast(a * u as double) end as debt_ratio from c""",
    "crossing_values": """
with l as (select * from lineitem where l_linenumber <= 2 qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1)
select cast(l_orderkey as varchar) as path, case l_linenumber when 1 then 'first' else 'second' end as label, h as heading,
  case h when 'quantity' then cast(cast(l_quantity as int) as varchar) else cast(l_suppkey as varchar) end as value from l, unnest(['quantity', 'supplier']) as t(h)""",
    "occupied_findings": "select cast(doc_id as varchar) as entity, 'occupied' as code, 'error' as severity from documents where doc_id in (select doc_id from labels where quality is not null)",
    "next_free_row": "select source, max(doc_id) + 1 as next_row from documents where doc_id % 7 <> 0 and lang is not null group by 1",
    "merge_plan": _MERGE + " select o_custkey, ordinal, pages, page_to - pages + 1 as page_from, page_to from m",
    "split_plan": _MERGE + _SCAN + """ select s.o_custkey, page, ordinal, name, page - (page_to - pages) as item_page
from s left join m on s.o_custkey = m.o_custkey and page > page_to - pages and page <= page_to""",
    "split_findings": _MERGE + """, f as (select 'page_extra' as code from m where o_custkey % 3 = 0 group by o_custkey
  union all select 'page_count' from m where o_custkey % 3 = 0 group by o_custkey union all select 'item_pages' from m where own <> 4)
select 'trading' as stage, 'error' as severity, code, count(*) as n from f group by code""",
    "batch_findings": _BATCH + """
select w.o_custkey || '/' || w.o_orderkey as entity, case when h.o_orderkey is null then 'file_missing' else 'file_changed' end as code
from w left join h using (o_custkey, o_orderkey) where h.o_orderkey is null or w.o_orderkey % 17 = 0
union all select h.o_custkey || '/' || h.o_orderkey, 'file_extra' from h anti join w using (o_custkey, o_orderkey)""",
    "batch_records": "select cast(o_custkey as varchar) as batch_id, '20240309' as task_date, count(*) as n_items, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as names from orders group by 1",
    "holdings_checks": _HOLDINGS + " select path, account and cash and pages as passed from h",
    "holdings_findings": _HOLDINGS + """ select path as entity, 'no_account' as code from h where not account union all select path, 'no_cash' from h where not cash
union all select path, 'page_count' from h where not pages""",
    "trade_numbers": """
with g as (select l_orderkey, cast((l_linenumber - 1) // 2 + 1 as bigint) as part_no, lpad(cast(max(l_partkey) as varchar), 8, '0') as number, count(*) as n_read from lineitem group by 1, 2)
select *, number || '-' || part_no || '.pdf' as name from g""",
    "read_answers": _ANSWERS + " select * from a",
    "answer_findings": _ANSWERS + """, n as (select path, count_if(q between 1 and 4) as n, count(distinct q) as d from a group by 1),
f as (select 'answer_invalid' as code from a where choices = 'F' union all select 'answer_double' from a where len(choices) > 1 and q <> 2
  union all select 'question_count' from n where n <> 4 or d <> 4)
select 'questionnaire' as stage, 'error' as severity, code, count(*) as n from f group by code""",
    "answers_from_sheet": """select cast(o_custkey as varchar) as path, o_orderkey + 1 as row, o_orderkey % 25 as q, o_orderstatus as choices from orders
where o_orderkey >= 1 and o_orderkey % 25 between 1 and 20""",
    "pick_cells": """
select cast(l_orderkey as varchar) as path, 'flag' as field, l_returnflag as value, 'A1' as ref from lineitem where l_linenumber = 1
union all select cast(l_orderkey as varchar), 'supplier', cast(l_suppkey as varchar), 'C2' from lineitem where l_linenumber = 2""",
    "row_block": """
select cast(l_orderkey as varchar) as path, 'S' || l_linenumber % 2 as sheet, cast(l_linenumber as int) as row, max(l_returnflag) as flag, max(cast(l_suppkey as varchar)) as supplier
from lineitem where l_linenumber >= 3 group by all""",
    "xlsx_cells": _LINES + """ select cast(l_orderkey as varchar) as path, row, col, [cast(l_linenumber as varchar), l_returnflag, cast(l_partkey as varchar)][col] as raw
from l, (select unnest(range(1, 4)) as col)""",
    "html_cells": _LINES + """ select cast(l_orderkey as varchar) as path, row, [1, 3, 4][k]::bigint as col, [cast(l_linenumber as varchar), l_returnflag, cast(l_partkey as varchar)][k] as raw
from l, (select unnest(range(1, 4)) as k)""",
    "pdf_fields": """
select cast(o_orderkey as varchar) as path, k as page_no, lpad(cast(o_orderkey as varchar), 8, '0') as trade, cast(k as varchar) as own_page
from (select o_orderkey, unnest(range(1, o_orderkey % 3 + 2)) as k from orders)""",
    "pdf_merged": """
with f as (select o_custkey, o_orderkey, o_orderkey % 3 + 1 as own, unnest(range(1, (o_orderkey % 3 + 2) // 2 * 2 + 1)) as k from orders)
select cast(o_custkey as varchar) as batch, row_number() over (partition by o_custkey order by o_orderkey, k) as page_no, k <= own as has_text,
  case when k <= own then lpad(cast(o_orderkey as varchar), 8, '0') end as trade from f""",
    "material": """
with p as (select cast(page_id % 100 as varchar) as case_id, 'p' || page_id || '.HTML' as name, html from pages)
select 'run' as run_id, case_id, '/in/' || case_id || '/' || name as path, name, 'html' as ext, sha256(html) as sha256, length(html) as length,
  case when len(case_id) >= 2 then cast(case_id as bigint) end as batch_no from p""",
    "pending_lines": "select 'demo | warn | ' || l_orderkey || ' | quantity | too many' as value from lineitem where l_quantity > 45",
    "source_records": """
with c as (select cast(c_nationkey * 1000 + c_custkey % 1000 as varchar) as case_id, c_custkey, unnest(['c_mktsegment', 'c_name']) as field, unnest([c_mktsegment, c_name]) as value from customer)
select case_id, '[' || string_agg('{"entity":"e","ordinal":' || c_custkey || ',"field":"' || field || '","value":"' || value || '","basis":"rule","status":"ok"}', ',' order by c_custkey, field) || ']' as record
from c group by 1""",
    "text_functions": """
with o as (select *, case when o_orderkey % 4 <> 0 then o_orderpriority end as mark, cast(o_orderdate as date) as d from orders)
select o_orderkey, strftime(d, '%Y-%m-%d') as start, case when o_orderkey % 3 <> 0 then strftime(d + 30, '%Y-%m-%d') end as end, o_orderkey % 3 = 0 as open_ended,
  case when o_orderstatus = 'O' then -o_totalprice else o_totalprice end as signed, mark, concat_ws('-', o_orderstatus, mark, strftime(d, '%m%d')) || '.pdf' as file,
  case when strftime(d, '%m%d') <> '0229' then '2023-' || strftime(d, '%m-%d') end as day,
  case o_orderstatus when 'A' then 'AC' when 'C' then 'AC' else 'AC' || o_orderstatus end as letters from o""",
    "control_total": """
select count(l_extendedprice) as n, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as total, cast(count_if(l_extendedprice is null) as bigint) as n_blank, 12.5::double as stated, 'mismatch' as status from lineitem""",
    "distinct_items": "select distinct o_custkey, o_orderstatus from orders",
    "common_keys": "select distinct o_orderkey as k from orders where o_orderkey in (select l_orderkey from lineitem)",
    "top_k": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
    "source_order": "select source, doc_id, row_number() over (order by source, doc_id) as ordinal from documents",
    "union_kinds": "select 'customer' as kind, c_name as name, c_mktsegment as segment, null::int as nation from customer union all select 'supplier', s_name, null, s_nationkey from supplier",
}
