"""Where a scan's documents begin, by the numbers recognised on its pages: gaps and islands, held against fixed lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import check, number


def islands(pages: DataFrame, batch: list[str], page: str, read: str, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(pages with number, island and gap; islands).

    A page without a recognised number belongs to the number before it. An island is a run of pages of one number: it
    begins where the number changes, and is named by its first page; pages before any number have none. gap is how
    many page numbers are missing before a page, -1 where its number was there before. order: what tells pages of one
    number apart; beyond it what was read does, and rows alike in all that keep one order from the first look to the
    second. Islands: batch, island, number, n_pages, n_read (pages that show the number), last_page, gaps.
    """
    order = [page, *(order or []), read]
    own = number.carried(pages, order, {"number": F.col(read), "__page": F.col(page)}, batch)
    begins = F.col("number").isNotNull() & ~F.col("number").eqNullSafe(F.col("number_before"))
    own = own.withColumns({"__start": F.when(begins, F.col(page)), "gap": F.coalesce(F.col(page) - F.col("__page_before") - 1, F.lit(0))})
    own = own.drop("__page", "__page_before", "number_before").withColumn("__again", F.col("gap") < 0)  # not the first of its page number
    own = number.carried(own, [*order, "__again"], {"island": F.col("__start")}, batch).drop("island_before", "__start", "__again")
    found = own.filter("island is not null").groupBy(*batch, "island", "number").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count(read).alias("n_read"), F.max(page).alias("last_page"), F.sum(F.when(F.col("gap") > 0, F.col("gap")).otherwise(0)).alias("gaps")
    )
    return own, found


def boundary_findings(pages: DataFrame, found: DataFrame, batch: list[str], page: str, size: int) -> DataFrame:
    """Findings where islands and parts of size pages disagree; the entity is batch/page or batch/island.

    page_missing, page_double: by page numbers. unread: a page before any number. length: an island that isn't size
    pages long. shifted: one that doesn't begin where a part of size pages does. number_again: a number with a second island.
    """
    who = lambda c: F.concat_ws("/", *(F.col(b).cast("string") for b in batch), F.col(c).cast("string"))
    out = check.findings(pages, F.col("gap") > 0, who(page), "page_missing", F.concat(F.col("gap").cast("string"), F.lit(" missing before")), "trading")
    out = out.unionByName(check.findings(pages, F.col("gap") < 0, who(page), "page_double", "the page number was there before", "trading"))
    out = out.unionByName(check.findings(pages, F.col("island").isNull(), who(page), "unread", "no number on it or before it", "trading"))
    out = out.unionByName(check.findings(found, F.col("n_pages") != size, who("island"), "length", F.concat(F.col("n_pages").cast("string"), F.lit(f" pages, not {size}")), "trading"))
    out = out.unionByName(check.findings(found, F.pmod(F.col("island") - 1, F.lit(size)) != 0, who("island"), "shifted", F.lit(f"not where a part of {size} pages begins"), "trading"))
    again = found.groupBy(*batch, "number").agg(F.min("island").alias("island"), F.count(F.lit(1)).alias("n"))
    return out.unionByName(check.findings(again, F.col("n") > 1, who("number"), "number_again", F.concat(F.col("n").cast("string"), F.lit(" islands")), "trading"))
