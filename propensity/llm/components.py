"""Connected components of an edge table, as Spark joins, by contraction.

Each round every vertex points to the smallest of itself and its neighbours (aggregated with map-side combining),
pointers jump once, and edges are rewritten to the pointed-to vertices; edges inside a merged vertex go. A star, or
any cluster around its smallest member, is gone after one round, so the rounds' edges shrink quickly. Rounds are
written to the shared folder, so no lineage builds up; only whether edges are left reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.session import materialize


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b) that has an edge to another: the smallest id reachable."""
    left = materialize(edges.where("a <> b").select(*_ordered(F.col("a"), F.col("b"))).distinct())
    labels = None
    while True:
        ends = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other")))
        up = left.select(F.inline(ends)).groupBy("id").agg(F.min("other").alias("other")).select("id", F.least("id", "other").alias("up"))
        up = materialize(up)
        top = up.select(F.col("id").alias("_id"), F.col("up").alias("top"))
        up = materialize(up.join(top, up["up"] == top["_id"]).select("id", F.col("top").alias("up")))
        if labels is None:
            labels = up.select("id", F.col("up").alias("component"))
        else:
            step = up.select(F.col("id").alias("_id"), "up")
            labels = materialize(labels.join(step, labels["component"] == step["_id"], "left").select("id", F.coalesce("up", "component").alias("component")))
        first, second = (up.select(F.col("id").alias(f"_{c}"), F.col("up").alias(f"_up_{c}")) for c in "ab")
        moved = left.join(first, left["a"] == first["_a"]).join(second, left["b"] == second["_b"])
        left = materialize(moved.where("_up_a <> _up_b").select(*_ordered(F.col("_up_a"), F.col("_up_b"))).distinct())
        if not left.limit(1).count():
            return labels
