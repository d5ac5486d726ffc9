"""What several operators use: models held by workers, joins that stand hot groups."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged, sweep  # noqa: F401  operators take it from here

#: A group is hot when it holds more than one row in HOT_SHARE; so there are fewer than HOT_SHARE hot groups.
HOT_SHARE = 1000

_held: dict[str, Any] = {}


def held(name: str, build: Callable[[], Any]) -> Any:
    """What build gave for this name, kept by a Python worker from task to task. It keeps one at a time: workers live on
    from operator to operator, and the next one's model takes the place of the last."""
    if name not in _held:
        _held.clear()
        _held[name] = build()
    return _held[name]


def taken(box) -> Any:
    """A broadcast's value, which the worker doesn't keep besides."""
    value = box.value
    vars(box).pop("_value", None)
    return value


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, salt: Column) -> DataFrame:
    """rows left-joined with one row of groups for each binary key.

    A group that holds over 1/HOT_SHARE of the total rows is matched by a broadcast of fewer than HOT_SHARE
    rows (the sizes add up to total at most, so the bound holds for any input); its rows then travel under
    a salted key that matches nothing, so no task of the shuffled join gets them all.
    """
    value = [c for c in groups.columns if c != key]
    hot = groups.filter(F.col(size) * HOT_SHARE > F.lit(total))
    hot = hot.select(F.col(key), F.lit(True).alias("__hot"), F.struct(*value).alias("__hot_value"))
    cold = groups.select(F.col(key).alias("__key"), F.struct(*value).alias("__cold_value"))
    salted = F.when(F.col("__hot"), F.unhex(F.sha2(salt.cast("string"), 256))).otherwise(F.col(key))
    out = rows.join(F.broadcast(hot), key, "left").withColumn("__key", salted).join(cold, "__key", "left")
    out = out.withColumn("__value", F.coalesce("__hot_value", "__cold_value"))
    return out.select(*rows.columns, *(F.col("__value")[c].alias(c) for c in value))
