"""Which version of a template a sheet was made from, by the texts at its anchors; then the fields of that version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import match_key
from ..staging import spread
from . import check, extract

SHEET = ("path", "sheet")


def choose(cells: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, sheet, template, n_anchors of the sheets with one best version; findings).

    anchors: template, row, col, text (compared without white space and case). A version covers a sheet if all its
    anchors are there; the covering one with the most anchors is best. All versions are matched in one pass over the
    cells, by an equi-join on position. Findings: template_tie (several are as good), no_template (none covers it; the
    reason names the one that is nearest).
    """
    need = anchors.groupBy(F.col("template").alias("__t")).agg(F.count(F.lit(1)).alias("need"))
    a = anchors.join(need, F.col("template") == F.col("__t")).select("template", "need", F.col("row").alias("__row"), F.col("col").alias("__col"), match_key(F.col("text")).alias("__text"))
    a = extract.few(a)
    own = cells.select(*SHEET, "row", "col", match_key(F.col("raw")).alias("__raw"))
    hit = own.join(a, (own["row"] == a["__row"]) & (own["col"] == a["__col"]) & (own["__raw"] == a["__text"]), "left")
    # a file's cells come together once; those that no anchor meets only say that the sheet is there
    hit = spread(hit.select(*SHEET, "template", "need", "__row", "__col"), "path")
    seen = hit.distinct().groupBy(*SHEET, "template", "need").agg(F.count("template").alias("have"))
    seen = seen.withColumn("covers", F.coalesce(F.col("have") == F.col("need"), F.lit(False)))
    per = seen.groupBy(*SHEET, "covers", "have").agg(F.count(F.lit(1)).alias("same"), F.min("template").alias("template"))
    sheets = per.groupBy(*SHEET).agg(F.max(F.struct("covers", "have", "same", "template")).alias("b")).select(*SHEET, "b.*")
    who = F.concat_ws(":", *SHEET)
    covered = F.col("covers")
    near = F.when(F.col("have") == 0, "nothing fits").otherwise(F.concat(F.lit("nearest: "), "template", F.lit(" with "), F.col("have").cast("string"), F.lit(" anchors")))
    found = check.findings(sheets, covered & (F.col("same") > 1), who, "template_tie", F.concat(F.col("same").cast("string"), F.lit(" versions fit as well")), "read")
    found = found.unionByName(check.findings(sheets, ~covered, who, "no_template", near, "read"))
    return sheets.filter(covered & (F.col("same") == 1)).select(*SHEET, "template", F.col("have").alias("n_anchors")), found


def fields(cells: DataFrame, anchors: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, sheet, template, field, value, source by the rules of each sheet's own version; findings of choose).

    rules as in extract.position_rules. A field whose cell is blank or absent gives no row.
    """
    chosen, found = choose(cells, anchors)
    # one key that all parts go by, so small parts aren't put together for the join's sorts (see spread)
    of = spread(chosen.filter("path is not null and sheet is not null").select(F.struct(*SHEET, "template").alias("__of")), "__of")
    picked = extract.pick_cells(cells, rules).filter("value is not null").withColumn("__at", F.struct("path", "source.sheet", "template"))
    own = picked.join(of, F.col("__at") == F.col("__of"))
    return own.select("path", F.col("source.sheet").alias("sheet"), "template", "field", "value", "source"), found
