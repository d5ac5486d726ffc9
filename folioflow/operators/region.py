"""Writing into a sheet that already holds something: where its table begins, where it goes on, what may be written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, match_key
from . import check

SHEET = ("path", "sheet")


def find_headers(cells: DataFrame, names: dict[str, str]) -> DataFrame:
    """Of each sheet the row that shows most of the names (of several the first): path, sheet, header_row, n_names,
    n_ties (other rows that show as many), columns (name -> column; of several the first).

    Names match without white space and case. Every row is a candidate; a sheet that shows none isn't there.
    """
    wanted = F.create_map(*(F.lit(x) for field, text in names.items() for x in ("".join(text.split()).lower(), field)))
    hits = cells.select(*SHEET, "row", "col", F.try_element_at(wanted, match_key(F.col("raw"))).alias("field")).filter("field is not null")
    hits = hits.groupBy(*SHEET, "row", "field").agg(F.min("col").alias("col"))
    rows = hits.groupBy(*SHEET, "row").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("field", "col"))).alias("c"))
    same = rows.groupBy(*SHEET, "n").agg(F.count(F.lit(1)).alias("same"), F.min(F.struct("row", "c")).alias("first"))
    best = same.groupBy(*SHEET).agg(F.max(F.struct("n", "same", "first")).alias("top"))
    return best.select(*SHEET, F.col("top.first.row").alias("header_row"), F.col("top.n").alias("n_names"), (F.col("top.same") - 1).alias("n_ties"), F.map_from_entries("top.first.c").alias("columns"))


def next_rows(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """headers with next_row: behind the last row below the header that holds something in one of its columns."""
    at = headers.select(*SHEET, "header_row", F.explode("columns").alias("field", "col"))
    held = cells.filter(blank_to_null(F.col("raw")).isNotNull()).join(at, [*SHEET, "col"]).filter("row > header_row")
    last = held.groupBy(*SHEET).agg(F.max("row").alias("__last"))
    return headers.join(last, list(SHEET), "left").withColumn("next_row", F.coalesce("__last", "header_row") + 1).drop("__last")


def placed(planned: DataFrame, headers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells to be written: path, sheet, row, col, field, value; findings of what has no place).

    planned: path, sheet, row (null: behind the last, by ordinal from 1), ordinal, field, value. A sheet without a
    header or with several equally good ones (header_tie), and a field without a column, are findings.
    """
    own = planned.join(headers, list(SHEET), "left").withColumn("__col", F.try_element_at("columns", F.col("field")))
    who = F.concat_ws(":", *SHEET, "field")
    sheet = F.concat_ws(":", *SHEET)
    found = check.findings(own, F.col("header_row").isNull(), who, "no_header", "no row shows a name", "statistics")
    found = found.unionByName(check.findings(own, F.col("header_row").isNotNull() & F.col("__col").isNull(), who, "no_column", "the header doesn't show it", "statistics"))
    found = found.unionByName(check.findings(headers, F.col("n_ties") > 0, sheet, "header_tie", "several rows show as many names", "statistics"))
    good = own.filter(F.col("__col").isNotNull() & (F.col("n_ties") == 0))
    row = F.coalesce(F.col("row"), F.col("next_row") + F.col("ordinal") - 1).cast("int").alias("row")
    return good.select(*SHEET, row, F.col("__col").alias("col"), "field", "value"), found


def overlay(existing: DataFrame, writes: DataFrame, update: bool = False) -> tuple[DataFrame, DataFrame]:
    """(the grid after writing: path, sheet, row, col, value, state; findings).

    state: kept (nothing planned), same (planned and there), written (into a blank), occupied (left as it is, a finding)
    or updated (written over, where update allows it). A blank write changes nothing. Cells meet by their key; a cell
    planned twice is a finding, and the least value counts.
    """
    keys = [*SHEET, "row", "col"]
    there = existing.groupBy(*keys).agg(F.max(blank_to_null(F.col("raw"))).alias("old"))
    plan = writes.filter(blank_to_null(F.col("value")).isNotNull()).groupBy(*keys).agg(F.min("value").alias("new"), F.count(F.lit(1)).alias("__n"))
    both = there.join(plan, keys, "full_outer")
    taken = F.when(F.lit(update), "updated").otherwise("occupied")
    state = F.when(F.col("new").isNull(), "kept").when(F.col("old").isNull(), "written").when(F.col("old") == F.col("new"), "same").otherwise(taken)
    grid = both.withColumn("state", state)
    who = F.concat_ws(":", *(F.col(k).cast("string") for k in keys))
    found = check.findings(grid, F.col("state") == "occupied", who, "occupied", "the target holds a value", "statistics")
    found = found.unionByName(check.findings(grid, F.col("__n") > 1, who, "planned_twice", F.concat(F.col("__n").cast("string"), F.lit(" writes")), "statistics"))
    value = F.when(F.col("state").isin("written", "updated"), F.col("new")).otherwise(F.col("old")).alias("value")
    return grid.filter("old is not null or new is not null").select(*keys, value, "state"), found
