"""Joins and matching. None of these forces a broadcast: Catalyst and AQE choose by measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import match_key
from . import number


def _unique(right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row for each non-null key: how many rows have it, and the least of their values (aggregated before the join)."""
    own = right.filter(F.col(key).isNotNull())
    return own.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*values)).alias("__value"))


def cardinality_join(left: DataFrame, right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Left join that never multiplies rows: values are filled only where exactly one row matches.

    match_status says matched, unmatched or duplicate; unmatched and duplicate rows keep null values. A null
    key is unmatched.
    """
    one = _unique(right, key, values)
    out = left.join(one, left[key] == one["__key"], "left")
    status = F.when(F.col("__n").isNull(), "unmatched").when(F.col("__n") > 1, "duplicate").otherwise("matched")
    filled = [F.when(F.col("__n") == 1, F.col("__value")[v]).alias(v) for v in values]
    return out.select(*left.columns, *filled, status.alias("match_status"))


def ordered_lookup(left: DataFrame, right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Left join by a key that is unique on the right, with found; the left side's ordinal column keeps the order.

    A key that isn't unique there is an error where it is asked for: it would multiply rows.
    """
    one = right.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*values)).alias("__value"))
    out = left.join(one, left[key] == one["__key"], "left")
    twice = F.raise_error(F.lit(f"{key} is not unique on the right"))
    own = [F.when(F.col("__n") > 1, twice).otherwise(F.col("__value")[v]).alias(v) for v in values]
    return out.select(*left.columns, *own, F.col("__n").isNotNull().alias("found"))


def fill_by_name(table: DataFrame, reference: DataFrame, name: str, value: str) -> DataFrame:
    """Fill blanks of value from reference by normalised name; existing values are never overwritten.

    fill_status: kept, filled, missing (no such name), duplicate (the reference has more than one value for it).
    """
    ref = reference.select(match_key(F.col(name)).alias("__ref"), F.col(value).alias("__new")).filter("__ref is not null and __new is not null")
    ref = ref.groupBy("__ref").agg(F.min("__new").alias("__new"), F.max("__new").alias("__other"))
    out = table.withColumn("__name", match_key(F.col(name))).join(ref, F.col("__name") == F.col("__ref"), "left")
    unsure = F.col("__new") != F.col("__other")
    status = F.when(F.col(value).isNotNull(), "kept").when(F.col("__new").isNull(), "missing").when(unsure, "duplicate").otherwise("filled")
    new = F.coalesce(F.col(value), F.when(~unsure, F.col("__new")))
    return out.select(*(c if c != value else new.alias(c) for c in table.columns), status.alias("fill_status"))


def reconcile(left: DataFrame, right: DataFrame, key: str, amount: str, tolerance: str = "0") -> DataFrame:
    """Sums of both sides by key, which should cancel out: key, left_sum, right_sum, gap, status ok / mismatch / left_only / right_only.

    Sums are exact decimals and are taken before the join.
    """
    side = lambda df, n: df.groupBy(F.col(key).alias(f"__{n}")).agg(F.sum(F.col(amount).cast("decimal(18,2)")).alias(f"{n}_sum"))
    a, b = side(left, "left"), side(right, "right")
    gap = F.col("left_sum") + F.col("right_sum")
    near = F.abs(gap) <= F.lit(tolerance).cast("decimal(18,2)")
    status = F.when(F.col("right_sum").isNull(), "left_only").when(F.col("left_sum").isNull(), "right_only").when(near, "ok").otherwise("mismatch")
    out = a.join(b, a["__left"].eqNullSafe(b["__right"]), "full_outer")
    return out.select(F.coalesce("__left", "__right").alias(key), "left_sum", "right_sum", gap.alias("gap"), status.alias("status"))


def assign_pages(pages: DataFrame, items: DataFrame, page: str = "page", start: str = "page_from", end: str = "page_to") -> DataFrame:
    """Each page with the item whose range holds it. Ranges become pages, so the range match is an equi-join."""
    own = items.filter(F.col(start) <= F.col(end)).withColumn("__page", F.explode(F.sequence(start, end)))
    return pages.join(own, pages[page] == own["__page"]).drop("__page")


def same_batch(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a whose batch identity is in b, blanks equal to blanks."""
    b = b.select(*(F.col(k).alias(f"__{k}") for k in keys))
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"__{k}"])
    return a.join(b, on, "left_semi")


def unmatched(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key), key, "left_anti")


def occupied(planned: DataFrame, existing: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Planned writes whose target already holds something."""
    return planned.join(existing.filter(F.col(value).isNotNull()).select(*keys), keys, "left_semi")


def band_join(labels: DataFrame, values: DataFrame, position: str, width: float, group: list[str]) -> DataFrame:
    """Pairs of a label and a value of one group whose positions differ by at most width.

    Values are dealt to bands of that width and labels to their band and both neighbours, so it is an equi-join
    with a rest condition, not a nested loop.
    """
    band = F.floor(F.col(position) / F.lit(width)).cast("long")
    near = labels.withColumn("__band", F.explode(F.array(band - 1, band, band + 1))).withColumnRenamed(position, "label_position")
    far = values.withColumn("__band", band)
    return near.join(far, [*group, "__band"]).filter(F.abs(F.col("label_position") - F.col(position)) <= width).drop("__band")


def nearest_in_band(labels: DataFrame, values: DataFrame, position: str, width: float, group: list[str], label: str, value: str) -> DataFrame:
    """label, group, value, distance: for each label the nearest value of its group, at most width away, that isn't the label itself.

    Ties go by group and value. Pairs are not made: of the values at one position only the two least are kept, as a label
    leaves out itself alone, and each position is told the nearest ones below and above it by number.carried. So it
    grows as the rows do, also where all of them lie in one band or at one position. A label that stands at several
    positions in values could meet nothing but itself on both sides; only where there are such labels, a second look on
    each side finds the nearest position beyond.
    """
    stands = F.col(position).isNotNull() & ~F.isnan(position)
    own, values = labels.filter(F.col(label).isNotNull() & stands), values.filter(F.col(value).isNotNull() & stands)
    least = Window.partitionBy(*group, position).orderBy(value)
    held = values.withColumn("__n", F.dense_rank().over(least)).filter("__n <= 2").groupBy(*group, position).agg(F.min(value).alias("__one"), F.max(value).alias("__two"))
    held = held.withColumn("__two", F.when(F.col("__two") != F.col("__one"), F.col("__two")))
    spots = held.unionByName(own.select(*group, position).distinct(), allowMissingColumns=True)
    spots = spots.groupBy(*group, position).agg(F.max("__one").alias("__one"), F.max("__two").alias("__two"))
    spread_out = values.groupBy(*group, value).agg(F.min(position).alias("__a"), F.max(position).alias("__b")).filter("__a < __b")
    again = not spread_out.isEmpty()
    here = F.when(F.col("__one").isNotNull(), F.struct(F.col(position).alias("at"), F.col("__one").alias("one"), F.col("__two").alias("two")))
    near = [here]
    for name, sign in (("__low", 1), ("__high", -1)):
        spots = number.carried(spots.withColumn("__at", F.col(position) * sign), ["__at"], {name: here}, group).drop(name)
        before = F.col(f"{name}_before")
        near.append(before)
        if again:  # what lies before a run of positions that hold one value, the same, and nothing else
            begins = F.col("__two").isNotNull() | before.isNull() | before["two"].isNotNull() | (before["one"] != F.col("__one"))
            beyond = F.when(F.col("__one").isNotNull() & begins, F.struct(before.alias("e")))
            spots = number.carried(spots, ["__at"], {f"{name}_beyond": beyond}, group).drop(f"{name}_beyond")
            near.append(F.col(f"{name}_beyond_before")["e"])
    spots = spots.select(*group, position, F.array(*near).alias("__near"))
    there = F.transform("__near", lambda e: F.struct(F.abs(F.col(position) - e["at"]).alias("distance"), F.when(e["one"] != F.col(label), e["one"]).otherwise(e["two"]).alias("value")))
    best = F.array_min(F.filter(there, lambda e: e["value"].isNotNull() & (e["distance"] <= width)))
    found = own.select(label, *group, position).join(spots, [*group, position]).withColumn("__best", best).filter("__best is not null")
    found = found.groupBy(label).agg(F.min(F.struct(F.col("__best.distance").alias("distance"), *group, F.col("__best.value").alias(value))).alias("__best"))
    return found.select(label, *(F.col("__best")[c].alias(c) for c in (*group, value, "distance")))


def conflicts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row for each key: how many different values it has, and value only where there is just one (else blank, to be flagged)."""
    out = rows.groupBy(*keys).agg(F.countDistinct(value).alias("n_values"), F.min(value).alias("__one"))
    return out.select(*keys, "n_values", F.when(F.col("n_values") == 1, F.col("__one")).alias(value), (F.col("n_values") > 1).alias("conflict"))


def common_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that both sides hold, once each; a key with a blank part is none."""
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_semi")
