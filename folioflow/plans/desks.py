"""The desks' workflows. Each takes and returns DataFrames; delivery and its gate are in sinks.deliver."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import even_pages, flipped, id_valid, in_units, ratio
from ..operators import check, extract, match, number, score
from ..operators.check import Policy
from ..staging import spread, staged

#: The failure policy of each pipeline.
POLICIES = {
    "register": Policy.FLAG,
    "questionnaire": Policy.ABORT,
    "trading": Policy.ABORT,
    "holdings": Policy.ALL_PASS,
    "policy": Policy.KEEP_ROW,
    "statistics": Policy.ABORT,
    "settlement": Policy.ABORT,
    "compliance": Policy.FLAG,
}


@dataclass(frozen=True)
class Profile:
    """A trading profile: what is padded, how many pages each option takes, how the scan is split."""

    name: str
    kind: str
    even: bool
    pages_each: int | None  # None: by the batch's own page counts


#: Page counts and padding of the documented materials.
PROFILES = {
    p.name: p
    for p in (
        Profile("option_confirmation", "confirmation", True, 4),
        Profile("forward_confirmation", "confirmation", True, 2),
        Profile("statement", "statement", False, None),
        Profile("holdings", "holdings", False, None),
    )
}


def compliance_fill(table: DataFrame, reference: DataFrame, name: str = "name", nature: str = "nature") -> tuple[DataFrame, DataFrame]:
    """(table with blank natures filled, findings for names that stay blank)."""
    out = match.fill_by_name(table, reference, name, nature)
    found = check.findings(out, F.col("fill_status").isin("missing", "duplicate"), F.col(name), "nature_blank", F.col("fill_status"), "compliance", "warn")
    return out, found


def policy_fill(table: DataFrame, policies: DataFrame, key: str, values: list[str], total: str, parts: list[str], tolerance: str = "0") -> tuple[DataFrame, DataFrame]:
    """Fill a policy table by contract number; check that the funding parts make up the total. Rows in doubt stay as they are, with a reason."""
    out = match.cardinality_join(table, policies, key, values)
    found = check.findings(out, F.col("match_status") != "matched", F.col(key), "match", F.col("match_status"), "policy", "warn")
    money = lambda c: F.col(c).cast("decimal(18,2)")
    gap = F.abs(sum((money(p) for p in parts[1:]), money(parts[0])) - money(total))
    off = (F.col("match_status") == "matched") & (gap.isNull() | (gap > F.lit(tolerance).cast("decimal(18,2)")))
    return out, found.unionByName(check.findings(out, off, F.col(key), "composition", "parts don't add up to the amount", "policy", "warn"))


def settlement(cumulative: DataFrame, export: DataFrame, key: str, values: list[str], amount: str, direction: str, outgoing: list[str], drop: list[str], tolerance: str = "0", stated: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(old layout in the cumulative list's order, new layout, findings).

    cumulative has ordinal and amount; export is looked up by contract number. The new layout drops columns and
    turns amounts into the customer's direction; a reverse check holds its sums against the company's. Amounts may be
    texts: what isn't a number is a finding, and blank from there on. stated: the new layout's total, a constant, to be met.
    """
    amounts = [c for c in (amount, "company_amount") if dict(cumulative.dtypes)[c] == "string"]
    wrong = [check.castable(cumulative, c, "decimal(18,2)", F.col("ordinal"), "settlement") for c in amounts]
    cumulative = cumulative.withColumns({c: F.col(c).try_cast("decimal(18,2)") for c in amounts})
    blank = check.findings(cumulative, F.col(key).isNull(), F.col("ordinal"), "key_blank", "no contract number", "settlement")
    double = check.findings(check.duplicates(export.filter(F.col(key).isNotNull()), [key]), F.lit(True), F.col(key), "key_double", "more than one row in the export", "settlement")
    old = staged(match.cardinality_join(cumulative, export, key, values), "settlement")  # three outputs come from it
    lost = check.findings(old, F.col("match_status") == "unmatched", F.col(key), "not_in_export", "no row in the export", "settlement")
    new = old.withColumn("customer_amount", flipped(F.col(amount).cast("decimal(18,2)"), F.col(direction), outgoing)).drop(*drop)
    both = match.reconcile(new.select(key, F.col("customer_amount").alias(amount)), cumulative.select(key, (-F.col("company_amount")).alias(amount)), key, amount, tolerance)
    off = check.findings(both, F.col("status") != "ok", F.col(key), "reverse_check", F.col("status"), "settlement")
    found = reduce(DataFrame.unionByName, [blank, double, lost, off, *wrong])
    if stated is not None:
        total = check.control_total(new, "customer_amount", stated, tolerance)
        said = F.concat(F.col("total").cast("string"), F.lit(" against "), F.col("stated").cast("string"), F.lit(", "), F.col("status"))
        found = found.unionByName(check.findings(total, F.col("status") != "ok", F.lit("total"), "control_total", said, "settlement"))
    return old, new, found


def questionnaire(paragraphs: DataFrame, points: DataFrame, cuts: list[float]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(answer sheet, scores, findings). A defect aborts the batch: the gate runs before anything is scored."""
    answers = score.read_answers(paragraphs)
    found = score.answer_findings(answers)
    check.gate(found, POLICIES["questionnaire"])
    return score.answer_sheet(answers, ["path"]), score.score(answers, points, cuts, ["path"]), found


def merge_plan(items: DataFrame, profile: Profile, batch: list[str]) -> DataFrame:
    """Where each item's pages go in the merged file of its batch, padded for duplex printing where the profile says so."""
    padded = items.withColumn("pages", even_pages(F.col("pages"), F.lit(profile.even)).cast("long"))
    return number.page_ranges(padded, ["ordinal"], "pages", batch)


def split_plan(pages: DataFrame, items: DataFrame, profile: Profile, batch: list[str]) -> tuple[DataFrame, DataFrame]:
    """(page of the scan -> item, findings) of the way back: names and order are those of the batch record."""
    plan = merge_plan(items, profile, batch)
    joined = pages.join(plan.filter("page_from <= page_to").withColumn("page", F.explode(F.sequence("page_from", "page_to"))), [*batch, "page"], "left")
    out = joined.withColumn("item_page", F.col("page") - F.col("page_from") + 1)
    extra = check.findings(out, F.col("ordinal").isNull(), F.col("page"), "page_extra", "no item has this page", "trading")
    there = pages.groupBy(*batch).agg(F.count(F.lit(1)).alias("__there"))
    want = plan.groupBy(*batch).agg(F.sum("pages").alias("__want"))
    who = F.concat_ws("/", *(F.col(b).cast("string") for b in batch))
    count = check.findings(want.join(there, batch, "left"), F.coalesce("__there", F.lit(0)) != F.col("__want"), who, "page_count", "scan and batch differ in pages", "trading")
    if profile.pages_each:
        count = count.unionByName(check.findings(items, F.col("pages") != profile.pages_each, F.col("ordinal"), "item_pages", f"{profile.pages_each} pages are expected", "trading"))
    return out, extra.unionByName(count)


def register(fields: DataFrame, persons: DataFrame, names: list[str], person_fields: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(one row for each case, checked persons, findings). A field in doubt is blanked and flagged; the rest goes on."""
    cases = extract.pivot_fields(fields, ["case_id"], names)
    good = F.coalesce(id_valid(F.col("id_no")), F.lit(False))
    checked = persons.withColumn("missing", check.missing_fields(person_fields)).withColumn("id_ok", good)
    checked = checked.withColumn("id_no", F.when(F.col("id_ok"), F.col("id_no")))
    clash = match.conflicts(persons, ["case_id", "name"], "id_no").filter("conflict")
    who = F.concat_ws("/", "case_id", "name")
    found = check.findings(checked, F.size("missing") > 0, who, "incomplete", F.array_join("missing", ","), "register", "warn")
    found = found.unionByName(check.findings(checked, ~F.col("id_ok"), who, "id_check", "id number missing or wrong", "register", "warn"))
    found = found.unionByName(check.findings(clash, F.lit(True), who, "conflict", "one name with different ids", "register", "warn"))
    clash = clash.select("case_id", "name", F.lit(True).alias("__clash"))
    checked = checked.join(clash, ["case_id", "name"], "left").withColumn("id_no", F.when(F.col("__clash").isNull(), F.col("id_no"))).drop("__clash")
    return cases, checked, found


def statement_figures(rows: DataFrame, factors: dict[str, int]) -> DataFrame:
    """assets, liabilities and profit in base units, net assets, and the debt ratio where there are assets."""
    money = {c: in_units(F.col(c), F.col("unit"), factors) for c in ("assets", "liabilities", "profit")}
    out = rows.withColumns(money)
    return out.withColumns({"net_assets": F.col("assets") - F.col("liabilities"), "debt_ratio": F.when(F.col("assets") > 0, ratio(F.col("liabilities"), F.col("assets")))})


def write_region(planned: DataFrame, existing: DataFrame, keys: list[str], value: str, update: bool = False) -> DataFrame:
    """Findings for planned writes over occupied cells; none if updates are allowed."""
    hit = match.occupied(planned, existing, keys, value)
    who: Column = F.concat_ws(":", *(F.col(k).cast("string") for k in keys))
    return check.findings(hit, F.lit(not update), who, "occupied", "the target holds a value", "statistics")


def next_free_row(existing: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The row after the last one that holds something, for each sheet."""
    return existing.filter(F.col(value).isNotNull()).groupBy(*keys).agg((F.max("row") + 1).alias("next_row"))


def holdings_checks(pages: DataFrame, batch: DataFrame, account_pattern: str, cash_pattern: str) -> tuple[DataFrame, DataFrame]:
    """(path and whether all checks passed, findings). pages: path, page_no, text; batch: path, pages as recorded.

    Some page must show the account, the last page the cash position, and their number must be the batch's. A file
    without any page fails all three. One aggregate for each file, so no file's pages come together.
    """
    seen = pages.groupBy("path").agg(
        F.bool_or(F.coalesce(F.col("text").rlike(account_pattern), F.lit(False))).alias("account"),
        F.max_by(F.coalesce(F.col("text").rlike(cash_pattern), F.lit(False)), F.col("page_no")).alias("cash"),
        F.count_distinct("page_no").alias("there"),
    )
    out = spread(batch.select("path", F.col("pages").alias("__want")), "path").join(seen, "path", "left").fillna({"account": False, "cash": False, "there": 0})
    out = out.withColumn("count_ok", F.coalesce(F.col("there") == F.col("__want"), F.lit(False)))
    passed = out.select("path", (F.col("account") & F.col("cash") & F.col("count_ok")).alias("passed"))
    found = check.findings(out, ~F.col("account"), F.col("path"), "no_account", "no page shows the account", "holdings")
    found = found.unionByName(check.findings(out, ~F.col("cash"), F.col("path"), "no_cash", "the last page shows no cash position", "holdings"))
    return passed, found.unionByName(check.findings(out, ~F.col("count_ok"), F.col("path"), "page_count", "not the batch's number of pages", "holdings"))
