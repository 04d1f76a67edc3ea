"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2 ** ring_bits`` slices.  Each shard owns many virtual nodes, each at a slice
drawn by hashing; a row hashes to a slice and from there belongs to the next virtual node
clockwise.  A shard takes no more rows than its bound: rows beyond it, in ring order,
continue clockwise to the next virtual node whose shard has room.  With ``load_factor``
1.0, the default, the bounds are the even shares themselves, so any two shards differ
by one row at most; a larger factor leaves slack and moves fewer rows when shards are added.

Rows are never gathered.  One aggregation counts them by slice.  The counts of the virtual
nodes, as many as the two parameters say, decide on the driver which range of ranks of each
node goes to which shard; a row then needs no more than its rank within its slice.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, Window, functions as F

from orderline_kpi.llm.common import filled
from orderline_kpi.sources.scratch import WorkArea


def ring_points(n_shards: int, virtual_nodes: int, ring_bits: int) -> list[tuple[int, int]]:
    """(slice, shard) of each virtual node in ring order; the first node drawn keeps a slice."""
    points: dict[int, int] = {}
    for node in range(virtual_nodes):
        for shard in range(n_shards):
            at = zlib.crc32(f"node {node} of shard {shard}".encode()) >> (32 - ring_bits)
            points.setdefault(at, shard)
    return sorted(points.items())


def shard_bounds(n_rows: int, n_shards: int, load_factor: float) -> list[int]:
    """The most rows each shard takes."""
    if load_factor < 1:
        raise ValueError("load_factor must be 1 or more")
    if load_factor == 1:
        return [n_rows // n_shards + (shard < n_rows % n_shards) for shard in range(n_shards)]
    return [-int(-load_factor * n_rows // n_shards)] * n_shards


def place(loads: list[int], shards: list[int], bounds: list[int]) -> list[tuple[int, int, int, int]]:
    """(node, shard, first rank, end rank) for the rows of each node, in the order of filling.

    In each round every node offers the rows it still has to the node where they have
    got to, in ring order; what finds no room goes on to the next node whose shard has some.
    A round in which rows are left over fills a shard, so there are at most as many rounds
    as shards, and one.
    """
    room = list(bounds)
    placed = []
    waiting = [(node, 0, node) for node, load in enumerate(loads) if load]
    while waiting:
        left = []
        for node, rank, at in waiting:
            shard = shards[at]
            end = min(loads[node], rank + room[shard])
            if end > rank:
                placed.append((node, shard, rank, end))
                room[shard] -= end - rank
            if end < loads[node]:
                left.append((node, end, at))
        waiting = []
        for node, rank, at in left:
            while not room[shards[at]]:
                at = (at + 1) % len(shards)
            waiting.append((node, rank, at))
    return placed


def shard(
    docs: DataFrame, n_shards: int = 8, virtual_nodes: int = 128, load_factor: float = 1.0,
    ring_bits: int = 16, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Put every row into a shard.

    Returns one row per row of ``docs``: the id, ``size`` (UTF-8 bytes of the text plus 1),
    ``text_crc32``, ``shard``, and ``slot``, its place in the shard, gapless from 0.  The
    key on the ring is the id with the checksum of the text, so rows that share an id, or
    have none, spread too.  Null texts count as empty.  Rows equal in id and text are told
    apart by nothing but their slots.  An empty table gives an empty result.  Other columns
    are not looked at.
    """
    spark = docs.sparkSession
    text = filled(F.col(text_column))
    crc = F.crc32(F.encode(text, "UTF-8"))
    work = WorkArea(spark, "sharding")
    # Equal rows are one from here on, with a count: they would share a slice.
    keys = work.table(
        docs.select(
            F.col(id_column).alias("id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            crc.alias("crc"),
        ).groupBy("id", "size", "crc").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("spot", F.xxhash64("id", "crc", "size"))
        .withColumn("slice", F.shiftrightunsigned("spot", 64 - ring_bits)),
        "keys",
    )
    points = ring_points(n_shards, virtual_nodes, ring_bits)
    nodes = _rows(spark, [
        {"first": before + 1, "last": at, "node": node}
        for node, (before, at) in enumerate(_arcs([at for at, _ in points], 1 << ring_bits))
    ] + [{"first": points[-1][0] + 1, "last": (1 << ring_bits) - 1, "node": 0}],
        "first long, last long, node int")
    slices = work.table(
        keys.groupBy("slice").agg(F.sum("copies").alias("load"))
        .join(F.broadcast(nodes.select("node", F.explode(F.sequence("first", "last")).alias("slice"))), "slice")
        # Slices behind the last node belong to the first one and come first in its order.
        .withColumn("before", F.coalesce(F.sum("load").over(
            Window.partitionBy("node").orderBy((F.col("slice") <= points[0][0]).cast("int"), "slice")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("slice", "load", "node", "before"),
        "slices",
    )
    loads = [0] * len(points)
    for row in slices.groupBy("node").agg(F.sum("load").alias("load")).collect():
        loads[row["node"]] = row["load"]
    ranges = []
    filled_to = [0] * n_shards
    for node, to, first, end in place(
        loads, [owner for _, owner in points], shard_bounds(sum(loads), n_shards, load_factor)
    ):
        ranges.append({"node": node, "shard": to, "first": first, "end": end, "slot": filled_to[to]})
        filled_to[to] += end - first
    # For each slice the ranges its rows fall into: a few more rows than the ring has slices.
    homes = slices.join(
        F.broadcast(_rows(spark, ranges, "node int, shard int, first long, end long, slot long")), "node"
    ).where((F.col("before") < F.col("end")) & (F.col("before") + F.col("load") > F.col("first"))).select(
        "slice", "shard", (F.col("first") - F.col("before")).alias("first"),
        (F.col("end") - F.col("before")).alias("end"), F.col("slot").alias("first_slot"),
    )
    order = Window.partitionBy("slice").orderBy("spot", "id", "crc", "size")
    ranked = keys.withColumn(
        "rank", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    ).withColumn("rank", F.explode(F.expr("sequence(rank, rank + copies - 1)")))
    return ranked.join(F.broadcast(homes), "slice").where(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    ).select(
        F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("first_slot") + F.col("rank") - F.col("first")).alias("slot"),
    )


def _arcs(points: list[int], size: int) -> list[tuple[int, int]]:
    return list(zip([-1, *points[:-1]], points, strict=True))


def _rows(spark, rows: list[dict], schema: str) -> DataFrame:
    """A table of a few rows out of literals of the plan."""
    return spark.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")).alias("row")
    ).select("row.*")
