"""Extraction by rules that are data: positions in sheets, patterns in text; every value with its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, captured

RULES = "template string, field string, sheet string, row int, col int"
#: Rules that may be sent to every task.
FEW_RULES = 20_000


def few(rules: DataFrame) -> DataFrame:
    """rules marked to travel whole to what they are joined with, if they are counted and found to be FEW_RULES at most."""
    return F.broadcast(rules) if rules.limit(FEW_RULES + 1).count() <= FEW_RULES else rules


def position_rules(spark: SparkSession, rules: list[tuple[str, str, str | None, int, int]]) -> DataFrame:
    """(template, field, sheet or None for any, row, column) as a DataFrame."""
    return spark.createDataFrame(rules, RULES)


def pick_cells(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """Fields by fixed position: an equi-join on (row, col) and the sheet where the rule names one.

    Cells share few positions, so up to FEW_RULES rules travel to the cells; with more, the join is shuffled.
    """
    r = few(rules.select("template", "field", F.col("sheet").alias("__sheet"), F.col("row").alias("__row"), F.col("col").alias("__col")))
    on = (cells["row"] == r["__row"]) & (cells["col"] == r["__col"]) & (r["__sheet"].isNull() | (cells["sheet"] == r["__sheet"]))
    source = F.struct("path", "sheet", cell_ref(F.col("row"), F.col("col")).alias("ref"), F.lit(None).cast("int").alias("page"))
    return cells.join(r, on).select("path", "template", "field", blank_to_null(F.col("raw")).alias("value"), source.alias("source"))


def cell_ref(row: Column, col: Column) -> Column:
    """A1 reference of a cell up to column ZZ."""
    letter = lambda n: F.char(n + 64)
    high = F.floor((col - 1) / 26).cast("int")
    return F.concat(F.when(high > 0, letter(high)).otherwise(""), letter((col - 1) % 26 + 1), row.cast("string"))


def row_block(cells: DataFrame, first_row: int, columns: dict[int, str], key: list[str] | None = None) -> DataFrame:
    """Records from first_row downwards, one for each sheet row; attributes are tied by row, never by value."""
    key = key or ["path", "sheet"]
    own = cells.filter((F.col("row") >= first_row) & F.col("col").isin(list(columns)))
    picked = [F.max(F.when(F.col("col") == c, blank_to_null(F.col("raw")))).alias(name) for c, name in columns.items()]
    out = own.groupBy(*key, "row").agg(*picked)
    return out.filter(F.coalesce(*(F.col(n) for n in columns.values())).isNotNull())


def pivot_fields(fields: DataFrame, keys: list[str], names: list[str], field: str = "field", value: str = "value") -> DataFrame:
    """One row for each key, a column for each name (a fixed list: no extra job to find them, no surprise columns)."""
    return fields.groupBy(*keys).agg(*(F.max(F.when(F.col(field) == n, F.col(value))).alias(n) for n in names))


def unpivot_fields(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Long form: keys, field, value (as text)."""
    return rows.select(*keys, *(F.col(n).cast("string").alias(n) for n in names)).unpivot(keys, names, "field", "value")


def best_reading(readings: DataFrame, keys: list[str], value: str, rank: str) -> DataFrame:
    """Of several readings the value of the least rank, with its source kept beside it (a struct travels as one)."""
    rest = [c for c in readings.columns if c not in keys]
    good = readings.filter(F.col(value).isNotNull())
    return good.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(rank, value)).alias("__best")).select(*keys, "__best.*")


def text_fields(pages: DataFrame, patterns: dict[str, str], text: str = "text") -> DataFrame:
    """A column for each pattern's first group, null where it doesn't match."""
    return pages.withColumns({name: captured(F.col(text), pattern) for name, pattern in patterns.items()})


def paragraphs(docs: DataFrame, text: str, separator: str = "\n") -> DataFrame:
    """A row for each part of a text, para_no from 1."""
    parts = docs.select(*(c for c in docs.columns if c != text), F.posexplode(F.split(text, separator)).alias("para_no", "text"))
    return parts.withColumn("para_no", F.col("para_no") + 1)


def nearest_value(pairs: DataFrame, keys: list[str], distance: Column) -> DataFrame:
    """For each label the nearest of its candidate values; ties by the values' own order."""
    rest = [c for c in pairs.columns if c not in keys]
    return pairs.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(distance, *rest)).alias("__one")).select(*keys, "__one.*")


def agreement(first: Column, second: Column) -> Column:
    """Two readings: agree, differ, one_only or missing."""
    both = first.isNotNull() & second.isNotNull()
    return F.when(both & (first == second), "agree").when(both, "differ").when(first.isNull() & second.isNull(), "missing").otherwise("one_only")


def in_order(rows: DataFrame, keys: list[str], order: str, value: str, name: str = "items") -> DataFrame:
    """The values of each key as an array in order."""
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]).alias(name))


def crossing(cells: DataFrame, row_labels: dict[str, str], headings: dict[str, str]) -> DataFrame:
    """Values where the row of a label meets the column of a heading: path, sheet, label, heading, row, col, value.

    Labels and headings are patterns by name; a value lies right of its label and below its heading. Equi-joins on
    the cells' own rows and columns; blank cells give nothing, a label that occurs twice gives both.
    """
    def named(patterns: dict[str, str], name: str) -> DataFrame:
        hit = F.explode(F.array(*(F.when(F.col("raw").rlike(p), F.lit(k)) for k, p in patterns.items())))
        return cells.select("path", "sheet", "row", "col", hit.alias(name)).filter(F.col(name).isNotNull())

    rows = named(row_labels, "label").withColumnRenamed("col", "__label_col")
    tops = named(headings, "heading").withColumnRenamed("row", "__heading_row")
    both = cells.select("path", "sheet", "row", "col", blank_to_null(F.col("raw")).alias("value")).filter("value is not null")
    both = both.join(rows, ["path", "sheet", "row"]).filter("col > __label_col")
    both = both.join(tops, ["path", "sheet", "col"]).filter("row > __heading_row")
    return both.select("path", "sheet", "label", "heading", "row", "col", "value")


def group_numbers(pages: DataFrame, keys: list[str], page: str, size: int, pattern: str, text: str = "text") -> DataFrame:
    """The greatest number that a pattern finds on each run of size pages: keys, part_no, number, n_read (pages that have one)."""
    part = F.floor((F.col(page) - 1) / size).cast("long") + 1
    found = captured(F.col(text), pattern)
    return pages.groupBy(*keys, part.alias("part_no")).agg(F.max(found).alias("number"), F.count(found).alias("n_read"))
