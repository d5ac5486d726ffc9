"""Recognised text as tokens with boxes: turned upright, read by where rows and columns cross, in the unit last named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import in_units
from ..staging import staged
from . import extract, number

PAGE = ("path", "page_no")
#: Labels and headings of a page that may travel as one row.
CROWD = 2000


def _turned(turn: Column, w: Column, h: Column) -> dict[str, Column]:
    """The box's columns as they lie when a page of a scan, turned clockwise by so many degrees, is turned to be read."""
    def at(name: str, quarter: Column, half: Column, three: Column) -> Column:
        return F.when(turn == 90, quarter).when(turn == 180, half).when(turn == 270, three).otherwise(F.col(name)).alias(name)

    return {
        "x0": at("x0", F.col("y0"), w - F.col("x1"), h - F.col("y1")),
        "y0": at("y0", w - F.col("x1"), h - F.col("y1"), F.col("x0")),
        "x1": at("x1", F.col("y1"), w - F.col("x0"), h - F.col("y0")),
        "y1": at("y1", w - F.col("x0"), h - F.col("y0"), F.col("x1")),
    }


def _about(pages: DataFrame) -> DataFrame:
    return pages.select(*PAGE, F.pmod("rotation", F.lit(360)).alias("__turn"), F.col("width").alias("__w"), F.col("height").alias("__h"))


def upright(tokens: DataFrame, pages: DataFrame) -> DataFrame:
    """tokens with boxes as they lie on the page when it is turned to be read.

    pages: path, page_no, rotation (degrees clockwise that the scan is turned by), width, height (of the scan). A page
    that isn't listed, or has another rotation than quarter turns, stays as it is.
    """
    own = tokens.join(_about(pages), list(PAGE), "left")
    of = _turned(F.col("__turn"), F.col("__w"), F.col("__h"))
    return own.select(*(of.get(c, F.col(c)) for c in tokens.columns))


def named(tokens: DataFrame, patterns: dict[str, dict[str, str]]) -> DataFrame:
    """The tokens that a pattern matches, with its kind and name (patterns are given so); a token that several match comes
    with each. One look at each token, and its text is made once: a filter would be pushed to where it is made."""
    tags = [(F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name")), p) for kind, own in patterns.items() for name, p in own.items()]
    hit = F.explode(F.array(*(F.when(F.col("text").rlike(p), tag) for tag, p in tags)))
    return tokens.select(*tokens.columns, hit.alias("__hit")).filter("__hit is not null").select(*tokens.columns, "__hit.*")


def _overlapping(a: DataFrame, b: DataFrame, low: str, high: str, band: float) -> DataFrame:
    """Pairs of a row of a (columns with a_ before) and one of b on a page, whose boxes overlap along an axis by at least
    half of the smaller one. Boxes are dealt to the bands that they touch; a pair that shares several is kept in the first."""
    def dealt(df: DataFrame, head: str) -> DataFrame:
        first, last = (F.floor(F.col(c) / F.lit(band)).cast("long") for c in (low, high))
        own = df.select(*(F.col(c).alias(c if c in PAGE else f"{head}{c}") for c in df.columns), first.alias(f"{head}first"), F.explode(F.sequence(first, F.greatest(first, last))).alias("__band"))
        return own

    both = dealt(a, "a_").join(dealt(b, "b_"), [*PAGE, "__band"]).filter(F.col("__band") == F.greatest("a_first", "b_first"))
    shared = F.least(F.col(f"a_{high}"), F.col(f"b_{high}")) - F.greatest(F.col(f"a_{low}"), F.col(f"b_{low}"))
    small = F.least(F.col(f"a_{high}") - F.col(f"a_{low}"), F.col(f"b_{high}") - F.col(f"b_{low}"))
    return both.filter((shared >= small / 2) & (shared > 0)).drop("__band", "a_first", "b_first")


_BOX = ("token_no", "x0", "y0", "x1", "y1")
#: Numbers first: pairs come about in the order of tokens, so sorting them by numbers is little work.
_KEYS = [*PAGE, "label_no", "heading_no", "label", "heading"]
_FOUND = [*_KEYS, "value_no", "value", "distance"]


def _by_bands(labels: DataFrame, headings: DataFrame, amounts: DataFrame, band: float) -> DataFrame:
    """All values in a label's row and a heading's column, found by bands: a page of any size is spread over tasks."""
    rows = _overlapping(labels, amounts, "y0", "y1", band).filter("b_x0 >= a_x1")
    rows = rows.select(*PAGE, F.col("a_name").alias("label"), F.col("a_token_no").alias("label_no"), F.col("b_token_no").alias("value_no"), F.col("b_text").alias("value"), (F.col("b_x0") - F.col("a_x1")).alias("right"))
    tops = _overlapping(headings, amounts, "x0", "x1", band).filter("b_y0 >= a_y1")
    tops = tops.select(*PAGE, F.col("a_name").alias("heading"), F.col("a_token_no").alias("heading_no"), F.col("b_token_no").alias("value_no"), (F.col("b_y0") - F.col("a_y1")).alias("down"))
    return rows.join(tops, [*PAGE, "value_no"]).withColumn("distance", F.col("right") + F.col("down")).select(*_FOUND)


def _by_pages(labels: DataFrame, headings: DataFrame, amounts: DataFrame) -> DataFrame:
    """The same for pages of few labels and headings: all three are dealt and sorted by page once, and a page's values are
    held against its labels, what is left against its headings."""
    def aside(df: DataFrame, head: str) -> DataFrame:
        return df.select(*PAGE, *(F.col(c).alias(f"{head}_{c}") for c in (*_BOX, "name")))

    def over(head: str, low: str, high: str) -> Column:
        a, b = F.col(f"{head}_{low}"), F.col(f"{head}_{high}")
        shared = F.least(F.col(high), b) - F.greatest(F.col(low), a)
        return (shared >= F.least(F.col(high) - F.col(low), b - a) / 2) & (shared > 0)

    both = amounts.join(aside(labels, "l"), list(PAGE)).filter((F.col("x0") >= F.col("l_x1")) & over("l", "y0", "y1"))
    both = both.join(aside(headings, "h"), list(PAGE)).filter((F.col("y0") >= F.col("h_y1")) & over("h", "x0", "x1"))
    distance = F.col("x0") - F.col("l_x1") + F.col("y0") - F.col("h_y1")
    names = [F.col(f"{k[0]}_name").alias(k) for k in ("label", "heading")] + [F.col(f"{k[0]}_token_no").alias(f"{k}_no") for k in ("label", "heading")]
    return both.select(*PAGE, *names, F.col("token_no").alias("value_no"), F.col("text").alias("value"), distance.alias("distance"))


def _sorted_out(tokens: DataFrame, patterns: dict[str, dict[str, str]]) -> tuple[DataFrame, DataFrame]:
    """The tokens that are values, and the few that are anything else, with kind and name; each token is looked at once."""
    found = staged(named(tokens.select(*PAGE, *_BOX, "text"), patterns), "found")
    return found.filter("kind = 'value'"), staged(found.filter("kind <> 'value'"), "marks")


def _crossings(amounts: DataFrame, marks: DataFrame, band: float, pages: DataFrame | None, crowd: int) -> DataFrame:
    """crossing_values of values and of marks, which are labels and headings by their kind."""
    labels, headings = (marks.filter(F.col("kind") == kind) for kind in ("label", "heading"))
    many = labels.unionByName(headings).groupBy(*PAGE).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > crowd).select(*PAGE)
    all_three = [df if pages is None else upright(df, pages) for df in (labels, headings, amounts)]
    if many.isEmpty():
        pairs = _by_pages(*all_three)
    else:
        few, crowded = ([df.join(many, list(PAGE), how) for df in all_three] for how in ("left_anti", "left_semi"))
        pairs = _by_pages(*few).unionByName(_by_bands(*crowded, band))
    return extract.nearest_value(pairs.select(*_FOUND), _KEYS, F.col("distance"))


def _patterns(labels: dict[str, str], headings: dict[str, str], value: str) -> dict[str, dict[str, str]]:
    return {"label": labels, "heading": headings, "value": {"value": value}}


def crossing_values(tokens: DataFrame, labels: dict[str, str], headings: dict[str, str], value: str, band: float, pages: DataFrame | None = None, crowd: int = CROWD) -> DataFrame:
    """For each label and heading the nearest value in the label's row, right of it, and in the heading's column, below it.

    tokens: path, page_no, token_no, text, box; upright, or as scanned where pages (as for upright) says how pages lie.
    labels, headings and value are patterns. Boxes are in one row or column where they overlap by half of the smaller one.
    Nearest is the least way right and down, then the least token_no. Only tokens that a pattern matches are looked at.
    A page's values meet all its labels, but for pages with more than crowd labels and headings, whose pairs are found by
    bands (band: about a row's height); the result is the same. path, page_no, label, heading, label_no, heading_no (their
    tokens), value, value_no, distance.
    """
    return _crossings(*_sorted_out(tokens, _patterns(labels, headings, value)), band, pages, crowd)


def unit_in_force(tokens: DataFrame, unit: str, document: str = "path", order: tuple[str, ...] = ("page_no", "token_no")) -> DataFrame:
    """tokens with unit: what the pattern's first group last found at or before the token, across page breaks; null before any."""
    found = F.nullif(F.regexp_extract("text", unit, 1), F.lit(""))
    return number.carried(tokens, list(order), {"unit": found}, [document]).drop("unit_before")


def statement_fields(tokens: DataFrame, pages: DataFrame, labels: dict[str, str], headings: dict[str, str], value: str, unit: str, factors: dict[str, int], band: float) -> DataFrame:
    """Statement figures off recognised pages: each label's and heading's nearest value with the unit in force at its
    token and the amount in base units (null where the unit isn't known or the value is no number)."""
    amounts, marks = _sorted_out(tokens, _patterns(labels, headings, value) | {"unit": {"unit": unit}})
    out = _crossings(amounts, marks, band, pages, CROWD)
    said = marks.filter("kind = 'unit'").select(*PAGE, F.col("token_no").alias("value_no"), F.nullif(F.regexp_extract("text", unit, 1), F.lit("")).alias("unit"))
    # across pages one row for each is carried: the last unit on it; on a page, what holds at a value is the last at or before it
    ends = said.filter("unit is not null").groupBy(*PAGE).agg(F.max_by("unit", F.struct("value_no", "unit")).alias("__last"))
    ends = ends.unionByName(marks.filter("kind = 'label'").select(*PAGE).distinct(), allowMissingColumns=True)
    came = number.carried(ends, ["page_no", "__last"], {"__unit": F.col("__last")}, ["path"]).groupBy(*PAGE).agg(F.max("__unit_before").alias("__came"))
    both = out.unionByName(said, allowMissingColumns=True).withColumn("__value", F.col("label").isNotNull())
    here = Window.partitionBy(*PAGE).orderBy("value_no", "__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("unit", F.last("unit", ignorenulls=True).over(here)).filter("__value").drop("__value")
    out = both.join(came, list(PAGE), "left").withColumn("unit", F.coalesce("unit", "__came")).drop("__came")
    plain = F.expr("try_cast(regexp_replace(value, ',', '') as decimal(18,6))")
    return out.withColumn("amount", in_units(plain, F.col("unit"), factors))
