"""Fields off the text of confirmations, statements and policies, by rules in order of trust; every value with its page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import check


@dataclass(frozen=True)
class Rule:
    """A pattern whose first group is a field's value. Of a field's rules the least rank that finds anything counts.

    kind: text, decimal (thousands' commas allowed), date (2024-01-31, 2024/1/31 or 2024.1.31). many: several different
    values are a list, not a doubt. Patterns are of Java's kind.
    """

    field: str
    pattern: str
    rank: int = 1
    kind: str = "text"
    many: bool = False


def typed(value: Column, kind: str) -> Column:
    """The value in its field's one form (text): trimmed; a plain decimal; yyyy-MM-dd. Null where it is none of that kind."""
    if kind == "decimal":
        return F.regexp_replace(value, ",", "").try_cast("decimal(28,6)").cast("string")
    if kind == "date":
        parts = F.split(value, "[-/.]")
        padded = F.concat_ws("-", F.get(parts, F.lit(0)), F.lpad(F.get(parts, F.lit(1)), 2, "0"), F.lpad(F.get(parts, F.lit(2)), 2, "0"))
        return padded.try_cast("date").cast("string")
    return F.nullif(F.trim(value), F.lit(""))


def read(pages: DataFrame, rules: list[Rule], path: str = "path", page: str = "page_no", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(path, field, value, page_no, rank, n_values, status for every path and field; findings).

    All rules are matched in one pass over the texts. Equal values are put together in their page, then in their file,
    before anything is compared, so a file of any length stays small. status: ok; missing (no rule found anything);
    invalid (found, but none of its kind); ambiguous (different values under the rank that counts: blank); list (many:
    the values in the order of their first pages, joined by ";"). page_no is the value's first page. A null text has
    no values; repeated pages change nothing.
    """
    kinds, many = {r.field: r.kind for r in rules}, {r.field for r in rules if r.many}

    def found(r: Rule) -> Column:
        hits = F.array_distinct(F.regexp_extract_all(text, F.lit(r.pattern), F.lit(1)))
        return F.transform(hits, lambda v: F.struct(F.lit(r.field).alias("field"), F.lit(r.rank).alias("rank"), v.alias("raw")))

    hits = pages.select(F.col(path).alias("path"), F.col(page).cast("long").alias("page_no"), F.explode(F.flatten(F.array(*map(found, rules)))).alias("h"))
    hits = hits.select("path", "page_no", "h.*").filter(F.trim("raw") != "")
    value = F.lit(None).cast("string")
    for field, kind in kinds.items():
        value = F.when(F.col("field") == field, typed(F.col("raw"), kind)).otherwise(value)
    each = hits.withColumn("value", value).groupBy("path", "field", "rank", "value").agg(F.min("page_no").alias("page_no"))
    # a rank without a value of the right kind doesn't count, but is remembered
    good = each.filter("value is not null").groupBy("path", "field", "rank").agg(
        F.count(F.lit(1)).alias("n_values"), F.min("page_no").alias("page_no"), F.min("value").alias("one"), F.array_sort(F.collect_list(F.when(F.col("field").isin(list(many)), F.struct("page_no", "value")))).alias("all")
    )
    best = good.groupBy("path", "field").agg(F.min_by(F.struct("rank", "n_values", "page_no", "one", "all"), "rank").alias("b")).select("path", "field", "b.*")
    tried = each.select("path", "field").distinct().withColumn("tried", F.lit(True))
    want = pages.select(F.col(path).alias("path")).distinct().withColumn("field", F.explode(F.array(*map(F.lit, kinds))))
    out = want.join(tried, ["path", "field"], "left").join(best, ["path", "field"], "left")
    listed = F.col("field").isin(list(many))
    status = F.when(F.col("rank").isNull(), F.when(F.col("tried"), "invalid").otherwise("missing")).when(listed, "list").when(F.col("n_values") > 1, "ambiguous").otherwise("ok")
    final = F.when(listed, F.array_join(F.transform("all", lambda s: s["value"]), ";")).when(F.col("n_values") == 1, F.col("one"))
    final = F.when(F.col("rank").isNotNull(), final)
    out = out.select("path", "field", final.alias("value"), F.when(final.isNotNull(), F.col("page_no")).alias("page_no"), "rank", F.coalesce("n_values", F.lit(0).cast("long")).alias("n_values"), status.alias("status"))
    who = F.concat_ws(":", "path", "field")
    doubts = check.findings(out, F.col("status").isin("missing", "invalid", "ambiguous"), who, "reading", F.col("status"), "read", "warn")
    return out, doubts
