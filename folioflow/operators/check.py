"""Validation: every rule gives findings; a gate stops delivery where a desk's policy says so."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..staging import staged


class Policy(Enum):
    """What a finding does. FLAG: blank it, go on. KEEP_ROW: leave the row as it is, with the reason. ABORT: an error stops the batch. ALL_PASS: any finding does."""

    FLAG = "flag"
    KEEP_ROW = "keep_row"
    ABORT = "abort"
    ALL_PASS = "all_pass"


class GateError(RuntimeError):
    """A batch that must not be delivered."""


def findings(rows: DataFrame, bad: Column, entity: Column, code: str, reason: Column | str, stage: str, severity: str = "error", run_id: str = "") -> DataFrame:
    """A finding for each row where bad holds."""
    why = F.lit(reason) if isinstance(reason, str) else reason
    return rows.filter(bad).select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.lit(severity).alias("severity"), entity.cast("string").alias("entity"), F.lit(code).alias("code"), why.alias("reason")
    )


def summary(found: DataFrame) -> DataFrame:
    return found.groupBy("stage", "severity", "code").agg(F.count(F.lit(1)).alias("n"))


def gate(found: DataFrame, policy: Policy) -> int:
    """The one action between a stage and its sink: raise if the policy forbids delivery, else return the number of findings."""
    by = {r.severity: r.n for r in found.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).collect()}
    if (policy is Policy.ABORT and by.get("error")) or (policy is Policy.ALL_PASS and by):
        raise GateError(f"not delivered: {by}")
    return sum(by.values())


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has, with their number; counted on the map side first."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_items(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys that were not found."""
    return expected.select(*keys).distinct().join(found.select(*keys).distinct(), keys, "left_anti")


def missing_fields(fields: list[str]) -> Column:
    """Names of the fields of a row that are null."""
    return F.array_compact(F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in fields)))


def coverage(rows: DataFrame, keys: list[str], item: str, domain: list) -> DataFrame:
    """For each key: n_items of the domain present, complete, and outside: items that are not in the domain."""
    inside = F.when(F.col(item).isin(domain), F.col(item))
    out = rows.groupBy(*keys).agg(F.countDistinct(inside).alias("n_items"), F.collect_set(F.when(~F.col(item).isin(domain), F.col(item))).alias("outside"))
    return out.withColumn("complete", F.col("n_items") == len(domain))


def composition(rows: DataFrame, keys: list[str], part: str, total: str, tolerance: str = "0") -> DataFrame:
    """Whether the parts of a key add up to its total: keys, parts_sum, total, status. Exact decimals; a null part makes it incomplete."""
    money = lambda c: F.col(c).cast("decimal(18,2)")
    out = rows.groupBy(*keys).agg(F.sum(money(part)).alias("parts_sum"), F.max(money(total)).alias("total"), F.bool_or(F.col(part).isNull()).alias("__gap"))
    near = F.abs(F.col("parts_sum") - F.col("total")) <= F.lit(tolerance).cast("decimal(18,2)")
    status = F.when(F.col("__gap") | F.col("total").isNull(), "incomplete").when(near, "ok").otherwise("mismatch")
    return out.select(*keys, "parts_sum", "total", status.alias("status"))


def all_pass(rows: DataFrame, keys: list[str], good: Column) -> DataFrame:
    """A key passes if every row does; an unknown (null) doesn't pass."""
    return rows.groupBy(*keys).agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("passed"))


def file_checks(material: DataFrame, name_pattern: str, copy_pattern: str, extensions: list[str], stage: str = "precheck") -> DataFrame:
    """Findings of a precheck: extension, name format, copies by name, duplicate names, duplicate contents."""
    def more_than_once(key: str, code: str) -> DataFrame:
        return findings(duplicates(material.filter(F.col(key).isNotNull()), [key]), F.lit(True), F.col(key), code, F.concat(F.col("n").cast("string"), F.lit(" files")), stage)

    material = staged(material.select("name", "ext", "sha256"), "precheck")  # contents are hashed once, whatever is asked of them
    name = F.col("name")
    out = findings(material, ~F.coalesce(F.lower("ext").isin(extensions), F.lit(False)), name, "extension", "not allowed for this task", stage)
    out = out.unionByName(findings(material, ~name.rlike(name_pattern), name, "name_format", "name is not in the agreed form", stage))
    out = out.unionByName(findings(material, name.rlike(copy_pattern), name, "copy", "looks like a copy of a file", stage))
    return out.unionByName(more_than_once("name", "duplicate_name")).unionByName(more_than_once("sha256", "duplicate_content"))


def control_total(rows: DataFrame, amount: str, stated: Column, tolerance: str = "0") -> DataFrame:
    """One row: n, total, n_blank, stated and status of a whole table against its stated total (a constant). Exact decimals; blanks make it incomplete."""
    money = F.col(amount).cast("decimal(18,2)")
    out = rows.agg(F.count(money).alias("n"), F.sum(money).alias("total"), F.count_if(money.isNull()).alias("n_blank"), F.max(stated.cast("decimal(28,2)")).alias("stated"))
    near = F.abs(F.col("total") - F.col("stated")) <= F.lit(tolerance).cast("decimal(18,2)")
    status = F.when((F.col("n_blank") > 0) | F.col("total").isNull() | F.col("stated").isNull(), "incomplete").when(near, "ok").otherwise("mismatch")
    return out.withColumn("status", status)


def castable(rows: DataFrame, column: str, kind: str, entity: Column, stage: str) -> DataFrame:
    """Findings where a text column holds something that isn't of a type (not_castable), or nothing (value_blank)."""
    own = blank_to_null(F.col(column))
    wrong = findings(rows, own.isNotNull() & own.try_cast(kind).isNull(), entity, "not_castable", F.concat(F.lit(f"{column} is no {kind}: "), own), stage)
    return wrong.unionByName(findings(rows, own.isNull(), entity, "value_blank", f"{column} is blank", stage))
