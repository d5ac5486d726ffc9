"""Numbering, paging and page ranges.

Where numbers run over a whole table, they are not taken by a window without a partition (one task): rows are
sorted by range, each part counts, and a part's first number is the count before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import staged


def running_total(rows: DataFrame, order: list[str], amount: Column, name: str, within: list[str] | None = None) -> DataFrame:
    """rows with the sum of amount over all rows up to this one, in a total order.

    within: columns that start the sum anew; a plain window then. Otherwise rows are dealt by range of the
    first order columns, summed in each part, and the parts' sums (one row for each part) are added.
    """
    upto = lambda w: w.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if within:
        return rows.withColumn(name, F.sum(amount).over(upto(Window.partitionBy(*within))))
    parts = rows.withColumn("__amount", amount).repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    parts = staged(parts, "numbered")  # a row's part must stay the same, whatever is computed again
    sums = parts.groupBy("__part").agg(F.sum("__amount").alias("__sum"))
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part only
    before = sums.select("__part", F.coalesce(F.sum("__sum").over(w), F.lit(0)).alias("__before"))
    own = F.sum("__amount").over(upto(Window.partitionBy("__part")))
    return parts.join(F.broadcast(before), "__part").withColumn(name, own + F.col("__before")).drop("__part", "__amount", "__before")


def carried(rows: DataFrame, order: list[str], values: dict[str, Column], within: list[str] | None = None) -> DataFrame:
    """rows with, for each name, the last value that isn't null up to this row (name) and before it (name_before), in a total order.

    within: columns that begin anew, null as one value. Rows are dealt by range of within and order, so neither a
    long table nor a large group comes to one task: each part looks back in itself, and what its first group had
    before is the last value among earlier parts' ends of that group. A part has one such group at most, so what is
    broadcast is a row for each part.
    """
    keys = within or []
    parts = rows.withColumns({f"__{name}": value for name, value in values.items()}).repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id())
    parts = staged(parts, "carried")  # a row's part must stay the same, whatever is computed again
    last = [F.max_by(f"__{name}", F.struct(F.col(f"__{name}").isNotNull(), *order)).alias(f"__{name}") for name in values]
    ends = parts.groupBy("__part", *keys).agg(*last)
    w = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part of a group
    came = ends.select("__part", *keys, *(F.last(f"__{name}", ignorenulls=True).over(w).alias(f"__{name}_came") for name in values))
    came = came.filter(reduce(Column.__or__, (F.col(f"__{name}_came").isNotNull() for name in values)))
    came = came.select(F.col("__part").alias("__p"), *(F.col(k).alias(f"__k_{k}") for k in keys), *(f"__{name}_came" for name in values))
    on = parts["__part"] == came["__p"]
    for k in keys:
        on = on & parts[k].eqNullSafe(came[f"__k_{k}"])
    here = Window.partitionBy("__part", *keys).orderBy(*order)
    upto, before = here.rowsBetween(Window.unboundedPreceding, Window.currentRow), here.rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(F.broadcast(came), on, "left")
    found = {name: F.coalesce(F.last(f"__{name}", ignorenulls=True).over(upto), F.col(f"__{name}_came")) for name in values}
    found |= {f"{name}_before": F.coalesce(F.last(f"__{name}", ignorenulls=True).over(before), F.col(f"__{name}_came")) for name in values}
    return out.select(*(c for c in rows.columns if c not in found), *(c.alias(name) for name, c in found.items()))


def serial(rows: DataFrame, order: list[str], start: int = 23, first_row: int = 3) -> DataFrame:
    """rows with serial (from start) and sheet_row (from first_row) in order."""
    out = running_total(rows, order, F.lit(1).cast("long"), "__n")
    return out.withColumns({"serial": F.col("__n") + (start - 1), "sheet_row": F.col("__n") + (first_row - 1)}).drop("__n")


def paginate(rows: DataFrame, order: list[str], per_page: int = 23) -> DataFrame:
    """rows with page_no and line_no: per_page entries a page, pages added as needed."""
    out = running_total(rows, order, F.lit(1).cast("long"), "__n")
    k = F.col("__n") - 1
    return out.withColumns({"page_no": F.floor(k / per_page).cast("long") + 1, "line_no": k % per_page + 1}).drop("__n")


def rank_within(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """rows with their place (from 1) among the rows of their keys. By numbers over the whole table, less the least of
    each key, so a key with most of the rows is not sorted in one task. Null is a key too."""
    out = running_total(rows, [*keys, *order], F.lit(1).cast("long"), "__n")
    least = out.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.min("__n").alias("__least"))
    on = reduce(Column.__and__, (out[k].eqNullSafe(least[f"__{k}"]) for k in keys))
    return out.join(least, on).withColumn(name, F.col("__n") - F.col("__least") + 1).select(*rows.columns, name)


def page_ranges(items: DataFrame, order: list[str], pages: str, within: list[str] | None = None) -> DataFrame:
    """items with page_from and page_to in a merged file. An item of no pages has page_to < page_from."""
    out = running_total(items, order, F.col(pages).cast("long"), "page_to", within)
    return out.withColumn("page_from", F.col("page_to") - F.col(pages) + 1)


def fixed_split(pages: DataFrame, page: str, size: int) -> DataFrame:
    """pages with part_no and part_page: parts of size pages."""
    k = F.col(page) - 1
    return pages.withColumns({"part_no": F.floor(k / size).cast("long") + 1, "part_page": k % size + 1})


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key. An aggregate, not a window: each task passes on one row a key. As rows have no fixed width
    Spark sorts them by key for it; a key's rows needn't fit in memory."""
    rest = [c for c in rows.columns if c not in keys]
    top = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return rows.groupBy(*keys).agg(top).select(*keys, "__row.*")
