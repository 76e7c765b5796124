"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _least(edges: DataFrame) -> DataFrame:
    """For each u the least of u and its neighbours: partly aggregated before the shuffle, so a hub costs a row per task."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return edges.select(F.explode(ends).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    around = _both(edges)
    out = around.join(_least(around), "u").filter("v > u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has an edge to one lesser node that has none itself: what the steps come to, and leave as it is."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = edges.select(F.explode(ends).alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
    return nodes.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, component (its least node) of every node that has an edge; edges has two columns of longs.

    Each round is written to the shared folder, so lineage stays short.  A graph of n nodes takes O(log n squared) rounds, and one
    of stars around their least nodes none.
    """
    a, b = edges.columns[:2]
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    now = materialise(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u != v").distinct(), "edges")
    for _ in range(most):
        if _are_stars(now):
            break
        now = materialise(_small_star(_large_star(now)), "edges")
    else:
        raise RuntimeError(f"no fixpoint after {most} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def linked(label: DataFrame, more: DataFrame) -> DataFrame:
    """label, what components has found, after more edges: only the components that these join are looked at again."""
    a, b = more.columns[:2]
    own = lambda end: label.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    pairs = more.join(own(a), a, "left").join(own(b), b, "left").select(F.coalesce(f"of_{a}", a).alias(a), F.coalesce(f"of_{b}", b).alias(b))
    found = materialise(components(pairs), "components")
    moved = label.join(found.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    new = found.join(label, "node", "left_anti")
    return moved.select("node", F.coalesce("to", "component").alias("component")).union(new.select("node", "component"))
