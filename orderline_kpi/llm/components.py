"""Connected components of a graph that no machine holds: distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderline_kpi.sources.scratch import WorkArea

#: A node is a hub if it has more links than this and than the ``_MAX_HUBS`` th part of all.
HUB = 1000
_MAX_HUBS = 10_000


def connected_components(links: DataFrame, work: WorkArea, hub: int = HUB) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b); the root is the component's smallest node.

    Large-star and small-star steps take turns: every node hands its neighbours on to the
    smallest node it knows, until each component is a star around its root.  Smallest
    neighbours are aggregated before they shuffle.  They are joined back to the links of a hub without a shuffle: hubs are
    at most twice ``_MAX_HUBS``, so the table of their neighbours is broadcast; only links of other nodes meet
    by node.  The result of a round is written, which cuts the lineage.  No links give no rows.
    """
    stars = work.table(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        n, degree, is_done = _state(stars)
        if is_done:
            break
        limit = max(hub, n // _MAX_HUBS)
        both = stars.union(stars.select("v", "u"))
        large = _with_least(both, limit, degree, work).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = work.table(large.distinct(), "large")
        # A node has no more smaller neighbours now than it had neighbours before.
        small = _with_least(large, limit, degree, work).select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        stars = work.table(small.select("x.*").where("u <> v").distinct(), "stars")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        stars.select("v", "v").distinct())


def _state(stars: DataFrame) -> tuple[int, int, bool]:
    """The number of links, the most links of one node, and whether nodes have one smaller neighbour at most, that has none."""
    ends = stars.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        stars.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    n, degree, wrong = nodes.agg(
        F.sum("up"), F.max(F.expr("up + down")), F.count_if(F.expr("up > 1 OR up = 1 AND down > 0"))).first()
    return n or 0, degree or 0, not wrong


def _with_least(links: DataFrame, limit: int, degree: int, work: WorkArea) -> DataFrame:
    """``links`` (u, v) with ``m``, the smallest of u and all its v; no u has more than ``degree``."""
    def least(rows: DataFrame) -> DataFrame:
        return rows.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))

    if degree <= limit:
        return links.join(least(links).select("u", "m"), "u")
    hubs = work.table(least(links).where(F.col("n") > limit).select("u", "m"), "hubs")
    others = links.join(F.broadcast(hubs.select("u")), "u", "left_anti")
    return links.join(F.broadcast(hubs), "u").select("u", "v", "m").union(
        others.join(least(others).select("u", "m"), "u"))
