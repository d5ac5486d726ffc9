"""Queries of the engine's own operators over the test tables, by name, and the same in DuckDB's SQL.

The tables are not office material, so each query shows an operator's semantics on an analogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import check, extract, match, number, score

#: Ours, for the analogue of a questionnaire: points of an event type, and cut-offs of the levels.
POINTS = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 5}
CUTS = [50, 56, 62, 68]
PAGE_CHARS = 1800


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def fill_nature(spark, sf):
    c = _t(spark, sf, "customer")
    table = c.select("c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("nature"))
    spaced = F.concat(F.lit(" "), F.substring("c_name", 1, 4), F.lit(" 　"), F.expr("substring(c_name, 5)"))
    ref = c.filter("c_custkey % 5 <> 0").select(F.upper(spaced).alias("name"), F.col("c_mktsegment").alias("nature"))
    return match.fill_by_name(table, ref, "name", "nature")


def match_cardinality(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity")
    return match.cardinality_join(o, li, "o_orderkey", ["l_partkey", "l_quantity"])


def ordered_lookup(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    o = number.running_total(o, ["o_totalprice", "o_orderkey"], F.lit(1).cast("long"), "ordinal")
    li = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(_money("l_quantity")).cast("double").alias("quantity"), F.count(F.lit(1)).alias("n_items"))
    return match.ordered_lookup(o, li, "o_orderkey", ["quantity", "n_items"]).select("ordinal", "o_orderkey", "quantity", "n_items", "found")


def reverse_reconcile(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", _money("l_extendedprice").alias("amount"), "l_returnflag", "l_linenumber")
    lost = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    other = li.withColumn("amount", F.when(lost, F.lit(0).cast("decimal(18,2)")).otherwise(-F.col("amount")))
    out = match.reconcile(li, other, "l_orderkey", "amount")
    return out.select("l_orderkey", F.col("left_sum").cast("double").alias("left_sum"), F.col("right_sum").cast("double").alias("right_sum"), F.col("gap").cast("double").alias("gap"), "status")


def composition_check(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", _money("l_extendedprice").alias("part"))
    total = li.groupBy("l_orderkey").agg((F.sum("part") + F.when(F.col("l_orderkey") % 7 == 0, F.lit("0.01")).otherwise(F.lit("0")).cast("decimal(18,2)")).alias("total"))
    out = check.composition(li.join(total, "l_orderkey"), ["l_orderkey"], "part", "total")
    return out.select("l_orderkey", F.col("parts_sum").cast("double").alias("parts_sum"), F.col("total").cast("double").alias("total"), "status")


def _answers(spark, sf):
    """All events of a user in order, as sheets of 20 answers."""
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return score.numbered_sheets(e, ["user_id"], ["ts", "event_id"], "event_type")


def _points(spark):
    return spark.createDataFrame([(q, c, p) for q in range(1, score.QUESTIONS + 1) for c, p in POINTS.items()], "q int, choice string, points long")


def score_levels(spark, sf):
    return score.score(_answers(spark, sf), _points(spark), CUTS, ["user_id", "sheet"])


def score_sheet(spark, sf):
    return score.score_sheet(_answers(spark, sf), _points(spark), CUTS, ["user_id", "sheet"])


def answer_coverage(spark, sf):
    rows = _t(spark, sf, "events").select("user_id", "event_type")
    domain = ["view", "click", "signup", "purchase"]
    return check.coverage(rows, ["user_id"], "event_type", domain).select("user_id", F.col("n_items").cast("long").alias("n_items"), F.size("outside").cast("long").alias("n_outside"), "complete")


def answer_sheet(spark, sf):
    return score.answer_sheet(_answers(spark, sf), ["user_id", "sheet"])


def missing_items(spark, sf):
    c = _t(spark, sf, "conversations").select("conv_id", "turn")
    expected = c.select("conv_id").distinct().withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))))
    return check.missing_items(expected, c, ["conv_id", "turn"])


def dup_content(spark, sf):
    d = _t(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"))
    return check.duplicates(d, ["sha256"])


def dup_names(spark, sf):
    return check.duplicates(_t(spark, sf, "part"), ["p_name", "p_brand"])


def file_precheck(spark, sf):
    p = _t(spark, sf, "pages").select(X.file_name(F.col("url")).alias("name"), F.lit("html").alias("ext"), F.sha2("html", 256).alias("sha256"))
    found = check.file_checks(p, "^[a-z]+[0-9]*$", "copy|副本", ["html"])
    return check.summary(found)


def serial_rows(spark, sf):
    return number.serial(_t(spark, sf, "customer").select("c_custkey", "c_name"), ["c_custkey"])


def register_pages(spark, sf):
    return number.paginate(_t(spark, sf, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "page_no", "line_no")


def _doc_pages(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", "lang", F.ceil(F.col("n_chars") / PAGE_CHARS).cast("long").alias("pages"))


def page_ranges(spark, sf):
    return number.page_ranges(_doc_pages(spark, sf), ["doc_id"], "pages").select("doc_id", "pages", "page_from", "page_to")


def page_assign(spark, sf):
    items = number.page_ranges(_doc_pages(spark, sf), ["doc_id"], "pages").select("doc_id", "page_from", "page_to")
    pages = items.filter("page_from <= page_to").select(F.explode(F.sequence("page_from", "page_to")).alias("page"))
    return match.assign_pages(pages, items).select("page", "doc_id")


def fixed_split(spark, sf):
    pages = _doc_pages(spark, sf).select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("pages"))).alias("page"))
    return number.fixed_split(pages.filter("page >= 1"), "page", 4)


def pad_even(spark, sf):
    d = _doc_pages(spark, sf)
    return d.select("doc_id", "pages", X.even_pages(F.col("pages"), F.col("lang") == "en").alias("printed"))


def latest_batch(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return number.latest(e, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


def latest_overall(spark, sf):
    e = _t(spark, sf, "events").select("user_id", "ts", "event_id")
    return number.latest(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


def pivot_fields(spark, sf):
    e = _t(spark, sf, "events").select("user_id", F.col("event_type").alias("field"), "event_id")
    return extract.pivot_fields(e, ["user_id"], sorted(POINTS), value="event_id")


def unpivot_fields(spark, sf):
    return extract.unpivot_fields(_t(spark, sf, "customer"), ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"])


def best_reading(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus")
    return extract.best_reading(li, ["l_orderkey"], "l_partkey", "l_linenumber").select("l_orderkey", "l_linenumber", "l_partkey")


def paragraphs(spark, sf):
    return extract.paragraphs(_t(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", F.col("para_no").cast("long").alias("para_no"), "text")


def last_letter(spark, sf):
    p = extract.paragraphs(_t(spark, sf, "documents").select("doc_id", "text"), "text")
    return p.select("doc_id", F.col("para_no").cast("long").alias("para_no"), X.captured(F.col("text"), "([A-Za-z]+)[.\\s]*$").alias("last_word"))


def extract_email(spark, sf):
    d = extract.text_fields(_t(spark, sf, "documents").select("doc_id", "text"), {"email": "([A-Za-z0-9._]+@[A-Za-z0-9.]+[A-Za-z])"})
    return d.filter("email is not null").select("doc_id", "email")


def path_parts(spark, sf):
    p = _t(spark, sf, "pages")
    url = F.col("url")
    return p.select("page_id", X.captured(url, "^[a-z]+://([^/]+)").alias("host"), X.file_name(url).alias("name"), X.two_digit_suffix(url).alias("suffix"))


def json_record(spark, sf):
    e = _t(spark, sf, "events")
    rec = F.from_json("props", "struct<k:bigint>")
    return e.select("event_id", rec["k"].alias("k"), F.to_json(F.struct("event_id", "user_id")).alias("record"))


def date_keys(spark, sf):
    d = F.col("o_orderdate")
    o = _t(spark, sf, "orders").select("o_orderkey", F.date_format(d, "yyyyMMdd").alias("ymd"), F.date_format(d, "MMdd").alias("md"), F.year(d).alias("y"))
    return o.select("o_orderkey", "ymd", "md", X.compact_date(F.col("ymd")).cast("string").alias("day"), X.compact_date(F.concat(F.col("y").cast("string"), F.col("md"))).cast("string").alias("day_of_year"))


def ordered_items(spark, sf):
    c = _t(spark, sf, "conversations")
    return extract.in_order(c, ["conv_id"], "turn", "role", "roles").select("conv_id", F.array_join("roles", ",").alias("roles"))


def debt_ratio(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", _money("c_acctbal").alias("assets"), (F.col("c_custkey") % 100 * 10).cast("decimal(18,2)").alias("liabilities"))
    net = (F.col("assets") - F.col("liabilities")).cast("double").alias("net")
    return c.select("c_custkey", F.when(F.col("assets") > 0, X.ratio(F.col("liabilities"), F.col("assets"))).alias("debt_ratio"), net)


def unit_amount(spark, sf):
    c = _t(spark, sf, "customer")
    unit = F.when(F.col("c_custkey") % 3 == 0, "yuan").when(F.col("c_custkey") % 3 == 1, "ten_thousand").otherwise("?")
    return c.select("c_custkey", X.in_units(_money("c_acctbal"), unit, {"yuan": 1, "ten_thousand": 10000}).cast("double").alias("amount"))


def name_conflict(spark, sf):
    return match.conflicts(_t(spark, sf, "part"), ["p_name", "p_size"], "p_brand")


def unmatched(spark, sf):
    return match.unmatched(_t(spark, sf, "documents").select("doc_id", "source"), _t(spark, sf, "labels"), "doc_id")


def occupied(spark, sf):
    return match.occupied(_t(spark, sf, "documents").select("doc_id", "source"), _t(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"], "quality")


def same_batch(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey")).alias("batch"))
    s = _t(spark, sf, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("batch")).distinct()
    return match.same_batch(c, s, ["batch"])


def id_checksum(spark, sf):
    digits = F.lpad(F.col("c_custkey").cast("string"), 17, "1")
    c = _t(spark, sf, "customer").select("c_custkey", digits.alias("digits"))
    return c.select("c_custkey", X.checksum_rest(F.col("digits")).cast("long").alias("rest"), X.id_valid(F.concat("digits", F.lit("X"))).alias("valid"))


def all_checks_gate(spark, sf):
    return check.all_pass(_t(spark, sf, "lineitem"), ["l_orderkey"], F.col("l_discount") < 0.1)


def findings_summary(spark, sf):
    li = _t(spark, sf, "lineitem")
    who = F.col("l_orderkey")
    found = check.findings(li, F.col("l_quantity") > 45, who, "quantity", "too many", "demo", "warn")
    return check.summary(found.unionByName(check.findings(li, F.col("l_tax") > 0.07, who, "tax", "too high", "demo")))


def missing_fields(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 != 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"))
    return c.select("c_custkey", F.array_join(check.missing_fields(["name", "segment"]), ",").alias("missing"))


def band_match(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", F.col("p_retailprice").alias("at"))
    labels = p.select(F.col("p_partkey").alias("label"), "p_brand", "at")
    return match.nearest_in_band(labels, p, "at", 5.0, ["p_brand"], "label", "p_partkey").select("label", "p_partkey")


def column_letters(spark, sf):
    n = _t(spark, sf, "nation")
    return n.select("n_nationkey", X.column_number(F.substring("n_name", 1, 2)).cast("long").alias("number"))


def rotation(spark, sf):
    return _doc_pages(spark, sf).select("doc_id", X.rotated(F.when(F.col("lang") == "en", 0).otherwise(90), -90).cast("long").alias("rotation"))


def agreement(spark, sf):
    li = _t(spark, sf, "labels")
    a, b = F.when(F.col("doc_id") % 3 != 0, F.col("quality")), F.when(F.col("doc_id") % 5 != 0, 1 - F.col("toxic"))
    return li.select("doc_id", extract.agreement(a, b).alias("reading"))


_QUERIES = (
    fill_nature, match_cardinality, ordered_lookup, reverse_reconcile, composition_check, score_levels, score_sheet, answer_coverage, answer_sheet, missing_items, dup_content,
    dup_names, file_precheck, serial_rows, register_pages, page_ranges, page_assign, fixed_split, pad_even, latest_batch, latest_overall, pivot_fields, unpivot_fields,
    best_reading, paragraphs, last_letter, extract_email, path_parts, json_record, date_keys, ordered_items, debt_ratio, unit_amount, name_conflict, unmatched, occupied,
    same_batch, id_checksum, all_checks_gate, findings_summary, missing_fields, band_match, column_letters, rotation, agreement,
)
QUERIES = {f.__name__: f for f in _QUERIES}

_RANGES = f"""
with d as (select doc_id, lang, cast(ceil(n_chars / {PAGE_CHARS}.0) as bigint) as pages from documents),
r as (select doc_id, pages, cast(sum(pages) over (order by doc_id rows unbounded preceding) as bigint) as page_to from d),
ranges as (select doc_id, pages, page_to - pages + 1 as page_from, page_to from r)"""
_ANSWERS = """
with n as (select user_id, event_type, row_number() over (partition by user_id order by ts, event_id) - 1 as k from events),
a as (select user_id, k // 20 + 1 as sheet, k % 20 + 1 as q, event_type from n)"""
_SCORES = """,
s as (select user_id, sheet, cast(sum(case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3 when 'purchase' then 4 else 5 end) as bigint) as score from a group by 1, 2),
l as (select user_id, sheet, score, case when score < 50 then 'C1' when score < 56 then 'C2' when score < 62 then 'C3' when score < 68 then 'C4' else 'C5' end as level from s)"""
_SHEETS = "select user_id, sheet, " + ", ".join(f"max(case when q = {k} then event_type end) as q{k}" for k in range(1, 21)) + " from a group by 1, 2"

ORACLES = {
    "fill_nature": """
with t as (select c_custkey, c_name as name, case when c_custkey % 3 <> 0 then c_mktsegment end as nature from customer),
r as (select lower(c_name) as k, c_mktsegment as new from customer where c_custkey % 5 <> 0)
select c_custkey, name, coalesce(nature, new) as nature,
  case when nature is not null then 'kept' when new is null then 'missing' else 'filled' end as fill_status
from t left join r on lower(regexp_replace(name, '\\s', '', 'g')) = k""".replace("\\\\", "\\"),
    "match_cardinality": """
with m as (select l_orderkey, count(*) as n, min(l_partkey) as p, min(l_quantity) as q from lineitem group by 1)
select o_orderkey, o_orderstatus, case when n = 1 then p end as l_partkey, case when n = 1 then q end as l_quantity,
  case when n is null then 'unmatched' when n > 1 then 'duplicate' else 'matched' end as match_status
from orders left join m on o_orderkey = l_orderkey""",
    "ordered_lookup": """
with o as (select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) as ordinal from orders),
l as (select l_orderkey, cast(sum(cast(l_quantity as decimal(18,2))) as double) as quantity, count(*) as n_items from lineitem group by 1)
select ordinal, o_orderkey, quantity, n_items, l_orderkey is not null as found from o left join l on o_orderkey = l_orderkey""",
    "reverse_reconcile": """
with a as (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as x,
  sum(case when l_returnflag = 'R' and l_linenumber = 7 then 0 else -cast(l_extendedprice as decimal(18,2)) end) as y from lineitem group by 1)
select l_orderkey, cast(x as double) as left_sum, cast(y as double) as right_sum, cast(x + y as double) as gap,
  case when x + y = 0 then 'ok' else 'mismatch' end as status from a""",
    "composition_check": """
with a as (select l_orderkey, sum(cast(l_extendedprice as decimal(18,2))) as x from lineitem group by 1),
b as (select l_orderkey, x, x + case when l_orderkey % 7 = 0 then cast('0.01' as decimal(18,2)) else 0 end as t from a)
select l_orderkey, cast(x as double) as parts_sum, cast(t as double) as total, case when x = t then 'ok' else 'mismatch' end as status from b""",
    "score_levels": _ANSWERS + _SCORES + " select * from l",
    "score_sheet": _ANSWERS + _SCORES + f" select w.*, l.score, l.level from ({_SHEETS}) w join l using (user_id, sheet)",
    "answer_coverage": """
select user_id, count(distinct case when event_type <> 'error' then event_type end) as n_items, count(distinct case when event_type = 'error' then 1 end) as n_outside,
  count(distinct case when event_type <> 'error' then event_type end) = 4 as complete from events group by 1""",
    "answer_sheet": _ANSWERS + " " + _SHEETS,
    "missing_items": """
select conv_id, cast(turn as bigint) as turn from (select distinct conv_id from conversations), range(6) as t(turn)
except select conv_id, turn from conversations""",
    "dup_content": "select sha256(text) as sha256, count(*) as n from documents group by 1 having count(*) > 1",
    "dup_names": "select p_name, p_brand, count(*) as n from part group by 1, 2 having count(*) > 1",
    "file_precheck": """
with p as (select string_split(url, '/')[-1] as name, sha256(html) as h from pages),
f as (select 'name_format' as code from p where not regexp_matches(name, '^[a-z]+[0-9]*$')
  union all select 'copy' from p where regexp_matches(name, 'copy|副本')
  union all select 'duplicate_name' from p group by name having count(*) > 1
  union all select 'duplicate_content' from p group by h having count(*) > 1)
select 'precheck' as stage, 'error' as severity, code, count(*) as n from f group by code""",
    "serial_rows": "select c_custkey, c_name, row_number() over (order by c_custkey) + 22 as serial, row_number() over (order by c_custkey) + 2 as sheet_row from customer",
    "register_pages": """
with n as (select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as k from orders)
select o_orderkey, k // 23 + 1 as page_no, k % 23 + 1 as line_no from n""",
    "page_ranges": _RANGES + " select doc_id, pages, page_from, page_to from ranges",
    "page_assign": _RANGES + ", p as (select cast(unnest(range(1, (select max(page_to) from ranges) + 1)) as bigint) as page) select page, doc_id from p join ranges on page >= page_from and page <= page_to",
    "fixed_split": f"""
with d as (select doc_id, unnest(range(1, cast(ceil(n_chars / {PAGE_CHARS}.0) as bigint) + 1)) as page from documents)
select doc_id, page, (page - 1) // 4 + 1 as part_no, (page - 1) % 4 + 1 as part_page from d""",
    "pad_even": _RANGES + " select doc_id, pages, case when lang = 'en' then pages + pages % 2 else pages end as printed from d",
    "latest_batch": "select user_id, event_type, event_id, value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
    "latest_overall": "select user_id, event_id from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
    "pivot_fields": "select user_id, " + ", ".join(f"max(case when event_type = '{k}' then event_id end) as {k}" for k in sorted(POINTS)) + " from events group by 1",
    "unpivot_fields": """
select c_custkey, 'c_name' as field, c_name as value from customer union all select c_custkey, 'c_mktsegment', c_mktsegment from customer
union all select c_custkey, 'c_nationkey', cast(c_nationkey as varchar) from customer""",
    "best_reading": "select l_orderkey, l_linenumber, l_partkey from lineitem qualify row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) = 1",
    "paragraphs": "with s as (select doc_id, string_split(text, chr(10)) as p from documents) select doc_id, unnest(range(1, len(p) + 1)) as para_no, unnest(p) as text from s",
    "last_letter": r"""
with s as (select doc_id, string_split(text, chr(10)) as p from documents), u as (select doc_id, unnest(range(1, len(p) + 1)) as para_no, unnest(p) as t from s)
select doc_id, para_no, nullif(regexp_extract(t, '([A-Za-z]+)[.\s]*$', 1), '') as last_word from u""",
    "extract_email": "select doc_id, regexp_extract(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+[A-Za-z])', 1) as email from documents where regexp_matches(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+[A-Za-z])')",
    "path_parts": "select page_id, nullif(regexp_extract(url, '^[a-z]+://([^/]+)', 1), '') as host, string_split(url, '/')[-1] as name, nullif(regexp_extract(url, '([0-9]{2})$', 1), '') as suffix from pages",
    "json_record": """select event_id, cast(json_extract(props, '$.k') as bigint) as k, '{"event_id":' || event_id || ',"user_id":' || user_id || '}' as record from events""",
    "date_keys": """
select o_orderkey, strftime(o_orderdate, '%Y%m%d') as ymd, strftime(o_orderdate, '%m%d') as md,
  strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m-%d') as day_of_year from orders""",
    "ordered_items": "select conv_id, string_agg(role, ',' order by turn, role) as roles from conversations group by 1",
    "debt_ratio": """
with c as (select c_custkey, cast(c_acctbal as decimal(18,2)) as a, cast(c_custkey % 100 * 10 as decimal(18,2)) as l from customer)
select c_custkey, case when a > 0 then cast(l as double) / cast(a as double) end as debt_ratio, cast(a - l as double) as net from c""",
    "unit_amount": """
select c_custkey, cast(cast(c_acctbal as decimal(18,2)) * case c_custkey % 3 when 0 then 1 when 1 then 10000 end as double) as amount from customer""",
    "name_conflict": """
select p_name, p_size, count(distinct p_brand) as n_values, case when count(distinct p_brand) = 1 then min(p_brand) end as p_brand,
  count(distinct p_brand) > 1 as conflict from part group by 1, 2""",
    "unmatched": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "occupied": "select doc_id, source from documents where doc_id in (select doc_id from labels where quality is not null)",
    "same_batch": """
with c as (select c_custkey, case when c_custkey % 4 <> 0 then c_nationkey end as batch from customer),
s as (select distinct case when s_suppkey % 2 = 0 then s_nationkey end as batch from supplier)
select c_custkey, batch from c where exists (select 1 from s where s.batch is not distinct from c.batch)""",
    "id_checksum": """
with d as (select c_custkey, lpad(cast(c_custkey as varchar), 17, '1') as x from customer),
s as (select c_custkey, list_sum(list_transform(range(1, 18), lambda i: cast(x[i] as bigint) * [7,9,10,5,8,4,2,1,6,3,7,9,10,5,8,4,2][i])) % 11 as r from d)
select c_custkey, cast(r as bigint) as rest, r = 2 as valid from s""",
    "all_checks_gate": "select l_orderkey, bool_and(l_discount < 0.1) as passed from lineitem group by 1",
    "findings_summary": """
select 'demo' as stage, 'warn' as severity, 'quantity' as code, count(*) as n from lineitem where l_quantity > 45 having count(*) > 0
union all select 'demo', 'error', 'tax', count(*) from lineitem where l_tax > 0.07 having count(*) > 0""",
    "missing_fields": """
select c_custkey, concat_ws(',', case when c_custkey % 2 = 0 then 'name' end, case when c_custkey % 3 = 0 then 'segment' end) as missing from customer""",
    "band_match": """
with l as (select p_partkey as label, p_brand, p_retailprice as pos from part)
select label, p_partkey from l join part p on p.p_brand = l.p_brand and abs(p_retailprice - pos) <= 5.0 and p_partkey <> label
qualify row_number() over (partition by label order by abs(pos - p_retailprice), p.p_brand, p_partkey) = 1""",
    "column_letters": "select n_nationkey, cast((ascii(upper(n_name[1])) - 64) * 26 + ascii(upper(n_name[2])) - 64 as bigint) as number from nation",
    "rotation": "select doc_id, cast(case when lang = 'en' then 270 else 0 end as bigint) as rotation from documents",
    "agreement": """
with r as (select doc_id, case when doc_id % 3 <> 0 then quality end as a, case when doc_id % 5 <> 0 then 1 - toxic end as b from labels)
select doc_id, case when a = b then 'agree' when a is not null and b is not null then 'differ' when a is null and b is null then 'missing' else 'one_only' end as reading from r""",
}
