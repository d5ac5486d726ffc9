"""Queries on paper work: workbooks scanned with pushed filters, recognised tokens, scans without borders, sheets that
already hold something, several documents about one person, several versions of a template. Each also in DuckDB's SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import check, extract, merge, number, readings, region, scan, templates, tokens
from .sinks import committed
from .sources import workbook_format
from .staging import shared_dir


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# workbooks


def workbook_scan(spark, sf):
    """Customers as workbooks of 50, with three sheets, delivered as files; two columns of one sheet read back."""
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("double").alias("balance"))
    book = F.concat(F.lit("customers-"), F.floor((F.col("c_custkey") - 1) / 50).cast("string"), F.lit(".xlsx")).alias("workbook")
    line = ((F.col("c_custkey") - 1) % 50 + 2).alias("row")
    sheets = [
        ("main", F.array(committed.cell("c_name"), committed.number_cell("balance"), committed.cell(F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))))),
        ("names", F.array(committed.cell("c_name"))),
        ("segments", F.array(committed.cell("c_mktsegment"), committed.cell("c_name"))),
    ]
    rows = [c.select(book, F.lit(k).alias("sheet_no"), F.lit(name).alias("sheet"), line, cells.alias("cells")) for k, (name, cells) in enumerate(sheets, 1)]
    folder = f"{shared_dir(spark)}/books-{uuid.uuid4().hex}"
    committed.workbooks(rows[0].unionByName(rows[1]).unionByName(rows[2]), folder)
    workbook_format.register(spark)
    cells = spark.read.format(workbook_format.FORMAT).option("glob", "customers-*.xlsx").load(folder)
    own = cells.filter("sheet = 'main' and row between 2 and 41 and col in (1, 3)")
    return own.select(F.substring_index("path", "/", -1).alias("workbook"), "sheet", "row", "col", "raw")


# recognised tokens

COLUMNS, ROWS, WIDTH, HEIGHT = 10, 20, 1000.0, 420.0


def _tokens(spark, sf):
    """Words of the documents on a grid of 20 rows and 10 columns a page; labels, headings, amounts and units planted; every
    page turned by a multiple of 90 degrees."""
    docs = _t(spark, sf, "documents").select(F.col("doc_id").alias("doc"), F.trim("text", F.lit(" \t\n\x0b\x0c\r")).alias("text")).filter("text <> ''")
    words = F.split("text", r"[\x20\x09-\x0D]+")
    own = docs.select("doc", F.col("doc").cast("string").alias("path"), F.posexplode(words).alias("i", "word"))
    own = own.select("doc", "path", F.expr("cast(i div 200 + 1 as int)").alias("page_no"), (F.col("i") % 200).alias("k"), "word", F.char_length("word").alias("n"))
    own = own.withColumns({"r": F.expr("cast(k div 10 as int)"), "c": F.col("k") % 10})
    text = (
        F.when((F.col("c") == 0) & (F.col("r") % 4 == 1), "assets:").when((F.col("c") == 0) & (F.col("r") % 4 == 2), "liabilities:")
        .when((F.col("r") == 0) & (F.col("c") == 3), "current").when((F.col("r") == 0) & (F.col("c") == 6), "prior")
        .when((F.col("r") > 0) & F.col("c").isin(3, 6) & (F.col("n") % 3 != 0), F.concat(F.col("n").cast("string"), F.lit(","), F.lpad(F.col("r").cast("string"), 3, "0"), F.lit(".5")))
        .when((F.col("r") > 0) & F.col("c").isin(4, 7), (F.col("n") * 10 + F.col("r")).cast("string"))
        .when((F.col("c") == 8) & (F.col("n") == 9), "(10k)").when((F.col("c") == 8) & (F.col("n") == 11), "(yuan)").otherwise(F.col("word"))
    )
    wide = F.when((F.col("r") == 0) & F.col("c").isin(3, 6), 180).otherwise(80)
    turn = (F.col("doc") + F.col("page_no")) % 4
    own = own.withColumns({"text": text, "turn": turn, "u0": (F.col("c") * 100 + F.col("n") % 7).cast("double"), "v0": (F.col("r") * 20 + F.col("k") % 3).cast("double")})
    own = own.withColumns({"u1": F.col("u0") + wide, "v1": F.col("v0") + 14})
    u0, v0, u1, v1 = (F.col(c) for c in ("u0", "v0", "u1", "v1"))
    pick = lambda a, b, c, d: F.when(F.col("turn") == 1, b).when(F.col("turn") == 2, c).when(F.col("turn") == 3, d).otherwise(a)
    box = [pick(u0, HEIGHT - v1, WIDTH - u1, v0), pick(v0, u0, HEIGHT - v1, WIDTH - u1), pick(u1, HEIGHT - v0, WIDTH - u0, v1), pick(v1, u1, HEIGHT - v0, WIDTH - u0)]
    out = own.select("path", "page_no", (F.col("k") + 1).alias("token_no"), "text", *(b.alias(name) for b, name in zip(box, ("x0", "y0", "x1", "y1"), strict=True)), F.lit(1.0).alias("confidence"))
    own = docs.select("doc", F.explode(F.sequence(F.lit(1), F.ceil(F.size(words) / 200).cast("int"))).alias("page_no"))
    sideways = turn % 2 == 1
    pages = own.select(F.col("doc").cast("string").alias("path"), "page_no", (turn * 90).cast("int").alias("rotation"), F.when(sideways, HEIGHT).otherwise(WIDTH).alias("width"), F.when(sideways, WIDTH).otherwise(HEIGHT).alias("height"))
    return out, pages


def statement_tokens(spark, sf):
    found, pages = _tokens(spark, sf)
    labels, headings = {"assets": "^assets:$", "liabilities": "^liabilities:$"}, {"current": "^current$", "prior": "^prior$"}
    out = tokens.statement_fields(found, pages, labels, headings, r"^[0-9][0-9,]*(\.[0-9]+)?$", r"^\((10k|yuan)\)$", {"10k": 10_000, "yuan": 1}, 20.0)
    return out.select("path", "page_no", "label", "heading", "label_no", "value_no", "value", "unit", F.col("amount").cast("double").alias("amount"))


def unit_context(spark, sf):
    """Lines of a return flag as one long document: a unit is named on few lines and holds until the next."""
    li = _t(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    unit = F.when(F.col("l_partkey") % 97 == 0, "10k").when(F.col("l_partkey") % 89 == 0, "yuan")
    out = number.carried(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], {"unit": unit}, ["l_returnflag"])
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "unit", F.when(F.col("unit") == "10k", F.col("l_quantity") * 10000).when(F.col("unit") == "yuan", F.col("l_quantity")).alias("amount"))


# scans


def _scan(spark, sf):
    """Thousands of orders as scans, a page each: pages missing and double, numbers unread, shifted and misread."""
    o = _t(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 1000).cast("long").alias("batch"), (F.col("o_orderkey") % 1000 + 1).cast("long").alias("page"), F.col("o_custkey").alias("k"))
    read = F.when(F.col("k") % 29 == 0, F.floor((F.col("page") + 1) / 4)).when(F.col("k") % 3 != 0, F.floor((F.col("page") - 1) / 4))
    o = o.filter("k % 37 <> 0").withColumn("read", F.concat(F.lit("T"), read.cast("long").cast("string")))
    return o.unionByName(o.filter("k % 41 = 0"))


def scan_islands(spark, sf):
    return scan.islands(_scan(spark, sf), ["batch"], "page", "read")[1]


def scan_findings(spark, sf):
    pages, found = scan.islands(_scan(spark, sf), ["batch"], "page", "read")
    return scan.boundary_findings(pages, found, ["batch"], "page", 4).select("entity", "code", "reason")


# sheets that hold something


def _sheet(spark, sf):
    """A sheet for each nation: two lines of text, headings in the third or fourth row in an order of their own, customers below."""
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"))
    path, sheet = F.col("nation").cast("string").alias("path"), F.lit("S").alias("sheet")
    at = lambda k: ((F.col("nation") + k) % 3 + 1).cast("int")
    head = (3 + F.col("nation") % 2).cast("int")
    texts = F.array(
        F.struct(F.lit(1).alias("row"), F.lit(1).alias("col"), F.lit("customers of a nation").alias("raw")), F.struct(F.lit(2).alias("row"), at(0).alias("col"), F.lit("name").alias("raw")),
        F.struct(head.alias("row"), at(0).alias("col"), F.lit(" Name").alias("raw")), F.struct(head.alias("row"), at(1).alias("col"), F.lit("Bal ance").alias("raw")), F.struct(head.alias("row"), at(2).alias("col"), F.lit("SEGMENT").alias("raw")),
    )
    top = n.select(path, sheet, F.explode(texts).alias("t")).select("path", "sheet", "t.*")
    c = _t(spark, sf, "customer").withColumn("nation", F.col("c_nationkey"))
    line = (head + 1 + F.col("c_custkey")).cast("int")
    cells = F.array(
        F.struct(line.alias("row"), at(0).alias("col"), F.col("c_name").alias("raw")),
        F.struct(line.alias("row"), at(2).alias("col"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).otherwise(" ").alias("raw")),
    )
    return top.unionByName(c.select(path, sheet, F.explode(cells).alias("t")).select("path", "sheet", "t.*"))


def _written(spark, sf, update):
    """Suppliers are added below, segments of every third customer filled in where they stand, and a field that no sheet has."""
    cells = _sheet(spark, sf)
    headers = region.next_rows(cells, region.find_headers(cells, {"name": "NAME", "balance": "balance", "segment": "Segment"}))
    s = _t(spark, sf, "supplier")
    new = s.select(F.col("s_nationkey").cast("string").alias("path"), F.lit(None).cast("int").alias("row"), F.col("s_suppkey").cast("int").alias("ordinal"), F.explode(F.array(F.struct(F.lit("name").alias("field"), F.col("s_name").alias("value")), F.struct(F.lit("balance").alias("field"), F.col("s_suppkey").cast("string").alias("value")), F.struct(F.lit("phone").alias("field"), F.lit("x").alias("value")))).alias("f"))
    c = _t(spark, sf, "customer").filter("c_custkey % 3 = 0")
    fill = c.select(F.col("c_nationkey").cast("string").alias("path"), (F.lit(4) + F.col("c_nationkey") % 2 + F.col("c_custkey")).cast("int").alias("row"), F.lit(1).alias("ordinal"), F.struct(F.lit("segment").alias("field"), F.when(F.col("c_custkey") % 2 == 0, "NEW").otherwise(F.col("c_mktsegment")).alias("value")).alias("f"))
    planned = new.unionByName(fill).select("path", F.lit("S").alias("sheet"), "row", "ordinal", "f.field", "f.value")
    writes, lost = region.placed(planned, headers)
    grid, found = region.overlay(cells, writes, update)
    return grid, lost.unionByName(found)


def write_grid(spark, sf):
    return _written(spark, sf, False)[0].select("path", "row", "col", "value", "state")


def write_grid_update(spark, sf):
    return _written(spark, sf, True)[0].select("path", "row", "col", "value", "state")


def write_grid_findings(spark, sf):
    return check.summary(_written(spark, sf, False)[1])


# several documents about one person


def _persons(spark, sf):
    c, k = _t(spark, sf, "customer"), F.col("c_custkey")
    case = (k % 40).cast("string").alias("case_id")
    form = c.filter(k % 11 != 0).select(case, F.concat(F.lit("Person "), k).alias("name"), F.col("c_phone").alias("phone") if "c_phone" in c.columns else F.concat(F.lit("p"), k).alias("phone"), F.when(k % 4 != 0, F.concat(F.lit("id"), k)).alias("id_no"))
    scan_ = c.filter(k % 3 != 0).select(case, F.concat(F.lit("PERSON"), k, F.lit(" ")).alias("name"), F.concat(F.lit("id"), k + F.when(k % 7 == 0, 1).otherwise(0)).alias("id_no"), F.concat(F.lit("m"), k % 5).alias("mail"))
    o = _t(spark, sf, "orders").withColumn("c_custkey", F.col("o_custkey"))
    letters = o.select(case, F.when(k % 13 != 0, F.concat(F.lit("person"), k)).alias("name"), F.concat(F.lit("m"), (k + F.when(F.col("o_orderkey") % 1009 == 0, 1).otherwise(0)) % 5).alias("mail"), F.col("o_orderpriority").alias("priority"))
    return merge.merge_sources({"form": form, "scan": scan_, "letter": letters}, ["case_id"], "name", ["id_no", "mail", "priority"], ["priority"])


def persons_merged(spark, sf):
    return _persons(spark, sf)[0]


def persons_findings(spark, sf):
    return check.summary(_persons(spark, sf)[1])


# readings


def _readings(spark, sf):
    """Documents as the pages of files of eight; fields by rules in order of trust."""
    d = _t(spark, sf, "documents").select(F.floor(F.col("doc_id") / 8).cast("string").alias("path"), (F.col("doc_id") % 8 + 1).alias("page_no"), "text")
    rules = [
        readings.Rule("mail", r"([a-z]+[0-9]*@[a-z]+\.[a-z]+)", 1), readings.Rule("mail", r"@([a-z]+)", 2), readings.Rule("card", r"\b([0-9]{16})\b", 1, "decimal", True),
        readings.Rule("number", r"\b([0-9]{1,3},[0-9]{3})\b", 1, "decimal"), readings.Rule("number", r"\b([0-9]{2,4})\b", 2, "decimal"), readings.Rule("day", r"\b([0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2})\b", 1, "date"),
        readings.Rule("license", r"(?:License|license):? ([A-Za-z]+)", 1), readings.Rule("start", r"^([A-Za-z]+)", 1, many=True),
    ]
    return readings.read(d, rules)


def ruled_fields(spark, sf):
    return _readings(spark, sf)[0]


def ruled_findings(spark, sf):
    return check.summary(_readings(spark, sf)[1].withColumn("code", F.concat_ws("_", "code", "reason")))


# versions of a template


def _versions(spark, sf):
    o, k = _t(spark, sf, "orders"), F.col("o_orderkey") % 6
    cell = lambda row, col, raw: F.struct(F.lit(row).alias("row"), F.lit(col).alias("col"), raw.cast("string").alias("raw"))
    total = F.col("o_totalprice").cast("decimal(18,2)")
    cells = F.array(
        cell(1, 1, F.when(k == 4, F.lit("Oder")).otherwise("Or der")), cell(2, 1, F.when(k != 5, F.lit("TOTAL"))), cell(3, 1, F.when(k.isin(1, 2), F.lit("status"))),
        cell(4, 1, F.when(k == 2, F.lit("Clerk"))), cell(5, 1, F.when(k == 3, F.lit("Ship"))), cell(6, 1, F.when(k == 3, F.lit("Mail"))),
        cell(1, 2, F.col("o_orderkey")), cell(2, 2, total), cell(2, 3, total + 1), cell(3, 2, F.col("o_orderstatus")), cell(4, 2, F.lit("  ")), cell(4, 3, F.col("o_orderpriority")),
    )
    cells = o.select(F.col("o_orderkey").cast("string").alias("path"), F.lit("S").alias("sheet"), F.explode(cells).alias("c")).select("path", "sheet", "c.*").filter("raw is not null")
    a = {"v1": [(1, "order"), (2, "total")], "v2": [(1, "order"), (2, "total"), (3, "Status")], "v3": [(1, "order"), (2, "total"), (3, "Status"), (4, "clerk")], "v4": [(1, "order"), (2, "total"), (5, "ship")], "v5": [(1, "order"), (2, "total"), (6, "mail")]}
    anchors = spark.createDataFrame([(t, row, 1, text) for t, own in a.items() for row, text in own], "template string, row int, col int, text string")
    rules = [("v1", "total", None, 2, 2), ("v2", "total", None, 2, 3), ("v2", "status", "S", 3, 2), ("v3", "total", None, 2, 3), ("v3", "clerk", None, 4, 2), ("v3", "priority", "S", 4, 3), ("v3", "status", "T", 3, 2)]
    return templates.fields(cells, anchors, extract.position_rules(spark, rules))


def template_fields(spark, sf):
    return _versions(spark, sf)[0].select("path", "template", "field", "value", F.col("source.ref").alias("ref"))


def template_findings(spark, sf):
    return _versions(spark, sf)[1].select("entity", "code", "reason")


_QUERIES = (workbook_scan, statement_tokens, unit_context, scan_islands, scan_findings, write_grid, write_grid_update, write_grid_findings, persons_merged, persons_findings, ruled_fields, ruled_findings, template_fields, template_findings)
QUERIES = {f.__name__: f for f in _QUERIES}

_SCAN = """
with o as (select o_orderkey // 1000 as batch, o_orderkey % 1000 + 1 as page, o_custkey as k from orders),
r as (select batch, page, 'T' || cast(case when k % 29 = 0 then (page + 1) // 4 when k % 3 <> 0 then (page - 1) // 4 end as varchar) as read, k from o where k % 37 <> 0),
p as (select batch, page, read from r union all select batch, page, read from r where k % 41 = 0),
f as (select *, last_value(read ignore nulls) over (partition by batch order by page rows unbounded preceding) as number, lag(page) over (partition by batch order by page) as page_before from p),
g as (select *, lag(number) over (partition by batch order by page) as before, coalesce(page - page_before - 1, 0) as gap from f),
pages as (select *, last_value(case when number is not null and number is distinct from before then page end ignore nulls) over (partition by batch order by page rows unbounded preceding) as island from g),
islands as (
  select batch, island, number, count(*) as n_pages, count(read) as n_read, max(page) as last_page, cast(sum(greatest(gap, 0)) as bigint) as gaps
  from pages where island is not null group by batch, island, number)"""

_GRID = """
with head as (select n_nationkey as n, 3 + n_nationkey % 2 as h, n_nationkey % 3 + 1 as c_name_, (n_nationkey + 1) % 3 + 1 as c_balance, (n_nationkey + 2) % 3 + 1 as c_segment from nation),
there as (
  select n, 1 as r, 1 as c, 'customers of a nation' as v from head union all select n, 2, c_name_, 'name' from head
  union all select n, h, c_name_, ' Name' from head union all select n, h, c_balance, 'Bal ance' from head union all select n, h, c_segment, 'SEGMENT' from head
  union all select n, h + 1 + c_custkey, c_name_, c_name from customer join head on n = c_nationkey
  union all select n, h + 1 + c_custkey, c_segment, c_mktsegment from customer join head on n = c_nationkey where c_custkey % 4 <> 0),
free as (select n, h, c_name_, c_balance, c_segment, coalesce(max(case when r > h then r end), h) + 1 as next from head left join there using (n) group by n, h, c_name_, c_balance, c_segment),
plan as (
  select n, next + s_suppkey - 1 as r, c_name_ as c, s_name as v from supplier join free on n = s_nationkey
  union all select n, next + s_suppkey - 1, c_balance, cast(s_suppkey as varchar) from supplier join free on n = s_nationkey
  union all select n, h + 1 + c_custkey, c_segment, case when c_custkey % 2 = 0 then 'NEW' else c_mktsegment end from customer join free on n = c_nationkey where c_custkey % 3 = 0),
met as (select coalesce(t.n, p.n) as n, coalesce(t.r, p.r) as r, coalesce(t.c, p.c) as c, t.v as old, p.v as new from there t full outer join plan p on t.n = p.n and t.r = p.r and t.c = p.c),
grid as (select *, case when new is null then 'kept' when old is null then 'written' when old = new then 'same' else '{taken}' end as state from met)"""


def _grid(taken: str) -> str:
    return _GRID.replace("{taken}", taken) + " select cast(n as varchar) as path, r as row, c as col, case when state in ('written', 'updated') then new else old end as value, state from grid"


_PERSONS = """
with form as (select cast(c_custkey % 40 as varchar) as case_id, c_custkey as k, 'Person ' || c_custkey as name, case when c_custkey % 4 <> 0 then 'id' || c_custkey end as id_no from customer where c_custkey % 11 <> 0),
scan as (select cast(c_custkey % 40 as varchar) as case_id, c_custkey as k, 'PERSON' || c_custkey || ' ' as name, 'id' || (c_custkey + case when c_custkey % 7 = 0 then 1 else 0 end) as id_no, 'm' || (c_custkey % 5) as mail from customer where c_custkey % 3 <> 0),
letter as (select cast(o_custkey % 40 as varchar) as case_id, o_custkey as k, case when o_custkey % 13 <> 0 then 'person' || o_custkey end as name, 'm' || ((o_custkey + case when o_orderkey % 1009 = 0 then 1 else 0 end) % 5) as mail, o_orderpriority as priority from orders),
u as (
  select case_id, k, name, 0 as s, id_no, null as mail, null as priority from form union all select case_id, k, name, 1, id_no, mail, null from scan
  union all select case_id, k, name, 2, null, mail, priority from letter),
g as (
  select case_id, k, min({'s': s, 'name': name}) as best, count(distinct s) as n_sources, min(id_no) as id_lo, max(id_no) as id_hi, min(case when id_no is not null then s end) as id_s, max(case when id_no is not null then s end) as id_t,
    min(mail) as m_lo, max(mail) as m_hi, min(case when mail is not null then s end) as m_s, max(case when mail is not null then s end) as m_t, min(priority) as p_lo, max(priority) as p_hi
  from u where name is not null group by case_id, k),
m as (
  select case_id, best.name as name, n_sources,
    case when id_lo = id_hi then id_lo end as id_no, case when id_lo = id_hi then (['form', 'scan', 'letter'])[id_s + 1] end as id_no_source,
    case when id_lo is null then 'missing' when id_lo <> id_hi then 'conflict' when id_t > id_s then 'agreed' else 'single' end as id_no_status,
    case when m_lo = m_hi then m_lo end as mail, case when m_lo = m_hi then (['form', 'scan', 'letter'])[m_s + 1] end as mail_source,
    case when m_lo is null then 'missing' when m_lo <> m_hi then 'conflict' when m_t > m_s then 'agreed' else 'single' end as mail_status,
    p_lo as priority, case when p_lo is not null then 'letter' end as priority_source, case when p_lo is null then 'missing' when p_lo <> p_hi then 'ranked' else 'single' end as priority_status
  from g)"""

_READINGS = r"""
with d as (select cast(doc_id // 8 as varchar) as path, doc_id % 8 + 1 as page_no, text from documents),
h as (
  select path, page_no, 'mail' as field, 1 as rank, unnest(regexp_extract_all(text, '([a-z]+[0-9]*@[a-z]+\.[a-z]+)', 1)) as raw from d
  union all select path, page_no, 'mail', 2, unnest(regexp_extract_all(text, '@([a-z]+)', 1)) from d
  union all select path, page_no, 'card', 1, unnest(regexp_extract_all(text, '\b([0-9]{16})\b', 1)) from d
  union all select path, page_no, 'number', 1, unnest(regexp_extract_all(text, '\b([0-9]{1,3},[0-9]{3})\b', 1)) from d
  union all select path, page_no, 'number', 2, unnest(regexp_extract_all(text, '\b([0-9]{2,4})\b', 1)) from d
  union all select path, page_no, 'day', 1, unnest(regexp_extract_all(text, '\b([0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2})\b', 1)) from d
  union all select path, page_no, 'license', 1, unnest(regexp_extract_all(text, '(?:License|license):? ([A-Za-z]+)', 1)) from d
  union all select path, page_no, 'start', 1, unnest(regexp_extract_all(text, '^([A-Za-z]+)', 1)) from d),
v as (
  select path, page_no, field, rank, case when field in ('card', 'number') then cast(try_cast(replace(raw, ',', '') as decimal(28, 6)) as varchar)
    when field = 'day' then cast(try_cast(split_part(regexp_replace(raw, '[-/.]', '-', 'g'), '-', 1) || '-' || lpad(split_part(regexp_replace(raw, '[-/.]', '-', 'g'), '-', 2), 2, '0') || '-' || lpad(split_part(regexp_replace(raw, '[-/.]', '-', 'g'), '-', 3), 2, '0') as date) as varchar)
    else raw end as value from h where trim(raw) <> ''),
e as (select path, field, rank, value, min(page_no) as page_no from v group by all),
g as (
  select path, field, rank, count(*) as n_values, min(page_no) as page_no, min(value) as one, string_agg(value, ';' order by page_no, value) as every
  from e where value is not null group by path, field, rank),
b as (select * from g qualify rank = min(rank) over (partition by path, field)),
w as (select distinct path, unnest(['mail', 'card', 'number', 'day', 'license', 'start']) as field from d),
o as (
  select w.path, w.field, case when b.field in ('card', 'start') then every when n_values = 1 then one end as value, b.page_no as first_page, b.rank, coalesce(n_values, 0) as n_values,
    case when b.rank is null then case when t.path is null then 'missing' else 'invalid' end when w.field in ('card', 'start') then 'list' when n_values > 1 then 'ambiguous' else 'ok' end as status
  from w left join b on b.path = w.path and b.field = w.field left join (select distinct path, field from e) t on t.path = w.path and t.field = w.field)"""

_VERSIONS = """
with o as (select o_orderkey, o_orderkey % 6 as k, cast(o_totalprice as decimal(18, 2)) as total, o_orderstatus, o_orderpriority from orders)"""

ORACLES = {
    "workbook_scan": """
with c as (select 'customers-' || ((c_custkey - 1) // 50) || '.xlsx' as workbook, (c_custkey - 1) % 50 + 2 as row, c_name, case when c_custkey % 3 <> 0 then c_mktsegment end as segment from customer)
select workbook, 'main' as sheet, row, 1 as col, c_name as raw from c where row between 2 and 41
union all select workbook, 'main', row, 3, segment from c where row between 2 and 41 and segment is not null""",
    "statement_tokens": r"""
with w as (select doc_id as doc, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
t as (select doc, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from w),
g as (select doc, i // 200 + 1 as page_no, i % 200 as k, (i % 200) // 10 as r, i % 10 as c, length(word) as n, word, i from t),
x as (
  select *, case when c = 0 and r % 4 = 1 then 'assets:' when c = 0 and r % 4 = 2 then 'liabilities:' when r = 0 and c = 3 then 'current' when r = 0 and c = 6 then 'prior'
    when r > 0 and c in (3, 6) and n % 3 <> 0 then n || ',' || lpad(cast(r as varchar), 3, '0') || '.5' when r > 0 and c in (4, 7) then cast(n * 10 + r as varchar)
    when c = 8 and n = 9 then '(10k)' when c = 8 and n = 11 then '(yuan)' else word end as text from g),
u as (select *, last_value(case when text in ('(10k)', '(yuan)') then substring(text, 2, length(text) - 2) end ignore nulls) over (partition by doc order by i rows unbounded preceding) as unit from x),
h as (select doc, page_no, c as hc, text as heading from u where r = 0 and text in ('current', 'prior') and c in (3, 6)),
l as (select doc, page_no, r, k + 1 as label_no, replace(text, ':', '') as label from u where c = 0 and r % 4 in (1, 2)),
v as (
  select l.doc, l.page_no, l.label, h.heading, l.label_no, u.k + 1 as value_no, u.text as value, u.unit, row_number() over (partition by l.doc, l.page_no, l.r, h.hc order by u.c) as rank
  from l join h on h.doc = l.doc and h.page_no = l.page_no join u on u.doc = l.doc and u.page_no = l.page_no and u.r = l.r and u.c in (h.hc, h.hc + 1) where regexp_full_match(u.text, '[0-9][0-9,]*(\.[0-9]+)?'))
select cast(doc as varchar) as path, page_no, label, heading, label_no, value_no, value, unit,
  cast(replace(value, ',', '') as double) * case unit when '10k' then 10000 when 'yuan' then 1 end as amount from v where rank = 1""",
    "unit_context": """
with u as (
  select *, last_value(case when l_partkey % 97 = 0 then '10k' when l_partkey % 89 = 0 then 'yuan' end ignore nulls) over (partition by l_returnflag
    order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity rows unbounded preceding) as unit from lineitem)
select l_returnflag, l_orderkey, l_linenumber, l_partkey, unit, cast(l_quantity as double) * case unit when '10k' then 10000 when 'yuan' then 1 end as amount from u""",
    "scan_islands": _SCAN + " select * from islands",
    "scan_findings": _SCAN + """
select batch || '/' || page as entity, 'page_missing' as code, gap || ' missing before' as reason from pages where gap > 0
union all select batch || '/' || page, 'page_double', 'the page number was there before' from pages where gap < 0
union all select batch || '/' || page, 'unread', 'no number on it or before it' from pages where island is null
union all select batch || '/' || island, 'length', n_pages || ' pages, not 4' from islands where n_pages <> 4
union all select batch || '/' || island, 'shifted', 'not where a part of 4 pages begins' from islands where (island - 1) % 4 <> 0
union all select batch || '/' || number, 'number_again', count(*) || ' islands' from islands group by batch, number having count(*) > 1""",
    "write_grid": _grid("occupied"),
    "write_grid_update": _grid("updated"),
    "write_grid_findings": _GRID.replace("{taken}", "occupied") + """
select 'statistics' as stage, 'error' as severity, 'occupied' as code, count(*) as n from grid where state = 'occupied'
union all select 'statistics', 'error', 'no_column', count(*) from supplier""",
    "persons_merged": _PERSONS + " select * from m",
    "persons_findings": _PERSONS + """,
f as (
  select 'id_no_conflict' as code from m where id_no_status = 'conflict' union all select 'mail_conflict' from m where mail_status = 'conflict'
  union all select 'priority_ranked' from m where priority_status = 'ranked' union all select 'no_name' from u where name is null)
select 'register' as stage, 'warn' as severity, code, count(*) as n from f group by code""",
    "ruled_fields": _READINGS + " select path, field, value, case when value is not null then first_page end as page_no, rank, n_values, status from o",
    "ruled_findings": _READINGS + " select 'read' as stage, 'warn' as severity, 'reading_' || status as code, count(*) as n from o where status in ('missing', 'invalid', 'ambiguous') group by status",
    "template_fields": _VERSIONS + """
select cast(o_orderkey as varchar) as path, 'v1' as template, 'total' as field, cast(total as varchar) as value, 'B2' as ref from o where k = 0
union all select cast(o_orderkey as varchar), 'v2', 'total', cast(total + 1 as varchar), 'C2' from o where k = 1
union all select cast(o_orderkey as varchar), 'v2', 'status', o_orderstatus, 'B3' from o where k = 1
union all select cast(o_orderkey as varchar), 'v3', 'total', cast(total + 1 as varchar), 'C2' from o where k = 2
union all select cast(o_orderkey as varchar), 'v3', 'priority', o_orderpriority, 'C4' from o where k = 2""",
    "template_findings": _VERSIONS + """
select o_orderkey || ':S' as entity, 'template_tie' as code, '2 versions fit as well' as reason from o where k = 3
union all select o_orderkey || ':S', 'no_template', 'nearest: v1 with 1 anchors' from o where k in (4, 5)""",
}
