"""Connected components of links, distributed: least labels and pointer jumps, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in links; component is the least id that can be reached.

    In a round each id takes the least label among its own and its neighbours', then the label of its label, so
    long chains shrink by more than a step. The rounds end when no label changes: then both ends of each link agree.
    """
    edges = staged(links.select(F.col(a).alias("u"), F.col(b).alias("v")).union(links.select(b, a)).filter("u <> v").distinct(), "edges")
    labels = staged(edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.least("u", "v").alias("component")), "labels")
    while True:
        near = edges.join(labels, edges["v"] == labels["id"]).groupBy("u").agg(F.min("component").alias("near"))
        hooked = labels.join(near, labels["id"] == near["u"], "left").select("id", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        before, hooked = labels, staged(hooked, "hooked")
        discard(before)
        up = hooked.select(F.col("id").alias("at"), F.col("new").alias("up"))
        moved = hooked.join(up, hooked["new"] == up["at"], "left").select("id", "old", F.least("new", "up").alias("component"))
        labels = staged(moved, "labels")
        discard(hooked)
        if not labels.filter("old <> component").limit(1).count():
            discard(edges)
            out = labels.select("id", "component")
            out.staged_path = labels.staged_path
            return out
