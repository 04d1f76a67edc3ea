"""Conversation prefix trie as a minimal-perfect-hash node table.

Every distinct sequence of first turns is a node, told by a digest that is chained from turn to turn.  Nodes
are enumerated by one aggregation over (conversation, turn), combined before it shuffles, so thousands of equal
conversations are one node per turn.  Then subtrees are dealt to shards.  In a shard a minimal perfect hash gives
each digest a slot without gaps; a slot holds its digest, and every look-up is compared with it.  Counts are
scattered into flat arrays by slot, and totals of subtrees are accumulated through the array of parent
slots, deepest nodes first.

**Cut.**  A node with more than ``cut`` conversations is *high*; so are all above it, and the root always is.  A shard
gets whole subtrees below high nodes, so a first turn that a third of all conversations share is no shard of
its own.  High nodes are at most ``conversations / cut`` per depth; with the totals of the subtrees below
them they make up one more table of the same kind.  ``cut`` is ``CUT`` or a ``MAX_HIGH`` th of all conversations, if
that is more, which bounds both kinds of tables.

**Order.**  Turns are in the order of ``turn`` (null first), then role and text digest.  A conversation that is very
long is streamed; no task holds its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderline_kpi.llm.common import filled
from orderline_kpi.llm.packing import bucket_bits
from orderline_kpi.sources.scratch import WorkArea

CUT, MAX_HIGH = 50_000, 10_000
_SHARD_NODES = 1 << 20
_BLOCK_BITS = 12  # ids of conversations that end at one node are joined in blocks of 4096 numbers
_ROOT = bytes(16)


class MinimalPerfectHash:
    """Slots 0 to n - 1 for n distinct digests (two columns of 64 bits).

    In each round the digests left are hashed to two places each; those alone at their place stay there,
    the others go on to the next round.  A slot is the rank of a place among all taken ones.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray) -> None:
        self.masks: list[np.ndarray] = []
        left = np.arange(len(high))
        while len(left):
            at = self._places(high[left], low[left], len(self.masks), 2 * len(left))
            mask = np.bincount(at, minlength=2 * len(left)) == 1
            self.masks.append(mask)
            left = left[~mask[at]]
            if len(self.masks) > 200:
                raise ValueError("digests are not distinct")
        self.before = np.cumsum([0, *[int(mask.sum()) for mask in self.masks]])
        self.ranks = [np.cumsum(mask) - 1 for mask in self.masks]
        self.high, self.low = np.empty(len(high), np.uint64), np.empty(len(high), np.uint64)
        slots = self._candidates(high, low)
        self.high[slots], self.low[slots] = high, low

    @staticmethod
    def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        h = (low ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31)) ^ high) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def _candidates(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        slots = np.full(len(high), -1, np.int64)
        open_ = np.arange(len(high))
        for level, mask in enumerate(self.masks):
            at = self._places(high[open_], low[open_], level, len(mask))
            here = mask[at]
            slots[open_[here]] = self.before[level] + self.ranks[level][at[here]]
            open_ = open_[~here]
        return slots

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that has none; verified by the digest that the slot holds."""
        slots = self._candidates(high, low)
        if not len(self.high):
            return slots
        right = (slots >= 0) & (self.high[slots] == high) & (self.low[slots] == low)
        return np.where(right, slots, -1)


def _digest(prefix: str) -> list[str]:
    return [f"{prefix}high", f"{prefix}low"]


#: One row per conversation and depth.  ``chars``: code points of the last text; ``is_end``: its last turn.
_STEPS = "conv_id long, depth long, high long, low long, parent_high long, parent_low long, chars long, is_end boolean"
_NODE = ("high long, low long, parent_high long, parent_low long, depth long, n_convs long, conv_id long, chars long")
_TOTALS = "parent_conv_id long, n_children long, n_leaves long, saved_tokens long"


def _chained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Steps of the trie, from turns in order; the first row of each conversation has no turn and stands for the root."""
    pending = None  # the last step of a conversation is known when the next row comes
    for frame in frames:
        steps = []
        for conv, turn, chars in zip(frame["conv_id"].tolist(), frame["digest"], frame["chars"].tolist(), strict=True):
            if turn is None:
                step = [conv, 0, _ROOT, _ROOT, 0, True]
            else:
                before = pending[2]
                pending[5] = False
                step = [conv, pending[1] + 1, xxhash.xxh3_128_digest(before + bytes(turn)), before, chars, True]
            if pending is not None:
                steps.append(pending)
            pending = step
        yield _step_frame(steps)
    yield _step_frame([pending] if pending is not None else [])


def _step_frame(steps: list[list]) -> pd.DataFrame:
    conv, depth, own, parent, chars, is_end = zip(*steps, strict=True) if steps else ([],) * 6
    halves = [np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2) for digests in (own, parent)]
    return pd.DataFrame({
        "conv_id": np.array(conv, np.int64), "depth": np.array(depth, np.int64),
        "high": halves[0][:, 0], "low": halves[0][:, 1], "parent_high": halves[1][:, 0], "parent_low": halves[1][:, 1],
        "chars": np.array(chars, np.int64), "is_end": np.array(is_end, bool),
    })


def accumulate(nodes: pd.DataFrame) -> pd.DataFrame:
    """Totals of all nodes of one table that holds, of each node, all descendants or their totals.

    ``more_children``, ``more_leaves`` and ``more_saved`` are totals of subtrees that hang below a node outside of the table.
    ``parent_conv_id`` stays empty where the parent is not in the table.
    """
    own = [nodes[c].to_numpy(np.int64).view(np.uint64) for c in _digest("")]
    parents = [nodes[c].to_numpy(np.int64).view(np.uint64) for c in _digest("parent_")]
    table, n = MinimalPerfectHash(*own), len(nodes)
    slot = table.slots(*own)
    if (slot < 0).any():
        raise ValueError("a digest has lost its slot")
    parent, depth, conv, children, leaves, saved = (np.zeros(n, np.int64) for _ in range(6))
    # The root is its own parent.
    parent[slot] = np.where((own[0] == parents[0]) & (own[1] == parents[1]), -1, table.slots(*parents))
    depth[slot], conv[slot] = nodes["depth"], nodes["conv_id"]
    saved[slot] = (nodes["n_convs"] - 1) * nodes["chars"] + nodes["more_saved"]
    children[slot], leaves[slot] = nodes["more_children"], nodes["more_leaves"]
    inside = np.flatnonzero(parent >= 0)
    np.add.at(children, parent[inside], 1)
    leaves[children == 0] = 1
    by_depth = inside[np.argsort(-depth[inside], kind="stable")]
    levels = np.flatnonzero(np.r_[True, np.diff(depth[by_depth]) != 0, True]) if len(by_depth) else []
    for a, b in zip(levels[:-1], levels[1:], strict=True):
        level = by_depth[a:b]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    above = parent[slot]
    return nodes.assign(
        parent_conv_id=pd.array(np.where(above >= 0, conv[above], 0), "Int64") if n else pd.array([], "Int64"),
        n_children=children[slot], n_leaves=leaves[slot], saved_tokens=saved[slot],
    ).assign(parent_conv_id=lambda f: f["parent_conv_id"].where(above >= 0))


def _totals(frame: pd.DataFrame) -> pd.DataFrame:
    names = [part.split()[0] for part in (f"{_NODE}, {_TOTALS}").split(", ")]
    return accumulate(frame)[names]


def _id_lists(ends: DataFrame) -> DataFrame:
    """``high, low, ends_sha256``: the digest of the ids of the conversations that end at each node, ascending.

    Ids are joined natively in blocks, so that a node at which a third of all conversations end is dealt to
    many tasks; the one that hashes it reads a few joined blocks, one after another.
    """
    blocks = ends.groupBy("high", "low", F.shiftright("conv_id", _BLOCK_BITS).alias("block")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for frame in frames:
            rows = []
            for high, low, ids in zip(frame["high"].tolist(), frame["low"].tolist(), frame["ids"], strict=True):
                if (high, low) == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = (high, low), hashlib.sha256(ids.encode())
            yield pd.DataFrame(rows, columns=["high", "low", "ends_sha256"])
        yield pd.DataFrame([(*node, state.hexdigest())] if node is not None else [], columns=["high", "low", "ends_sha256"])

    return blocks.repartition("high", "low").sortWithinPartitions("high", "low", "block").mapInPandas(
        run, "high long, low long, ends_sha256 string")


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, place, digest, chars`` of all turns with a conversation id; places from 1 in the order of the turns."""
    role, text = filled(F.col("role")), filled(F.col("text"))
    # Lengths keep apart what is role and what is text.
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    own = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        digest.alias("digest"), F.char_length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return own.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "digest", "chars")


def rebuilt_turns(numbered: DataFrame, host: Column, borrowed: Column, most: int) -> DataFrame:
    """``conv_id, part, place, digest, chars`` of the turns of every rebuilt conversation, and one row (part 0) for each.

    A conversation takes the first ``borrowed`` (at most ``most``) turns of conversation ``host``, then its own behind as many.
    """
    numbered = numbered.withColumns({"h": borrowed.cast("long"), "host": host})
    convs = numbered.where("place = 1").select("conv_id", "h", "host")
    heads = numbered.where((F.col("place") <= most) & (F.col("conv_id") == F.col("host"))).select(
        F.col("conv_id").alias("host"), "place", "digest", "chars")
    first = convs.where("h > 0").join(heads, "host").where("place <= h").select(
        "conv_id", F.lit(1).alias("part"), "place", "digest", "chars")
    rest = numbered.where("place > h").select("conv_id", F.lit(2).alias("part"), "place", "digest", "chars")
    marks = convs.select(
        "conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("chars"))
    return marks.union(first).union(rest)


def prefix_trie(rebuilt: DataFrame, work: WorkArea, cut: int = CUT, max_high: int = MAX_HIGH) -> DataFrame:
    """One row per node of the trie of ``rebuilt`` (conv_id, part, place, digest, chars; one row of part 0 each).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and the node's digest (high, low).  No conversations give no nodes, not even a root.
    """
    spark = rebuilt.sparkSession
    ordered = rebuilt.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    steps = work.table(ordered.select("conv_id", "digest", "chars").mapInPandas(_chained, _STEPS), "steps")
    ends = _id_lists(steps.where("is_end").select("high", "low", "conv_id"))
    counts = steps.groupBy("high", "low", "parent_high", "parent_low", "depth").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("chars").alias("chars"))
    nodes = work.table(counts.join(ends, ["high", "low"], "left"), "nodes")
    n_convs, n_nodes = nodes.agg(F.max("n_convs"), F.count(F.lit(1))).first()
    cut = max(cut, -(-(n_convs or 0) // max_high))
    is_high = (F.col("n_convs") > cut) | (F.col("depth") == 0)
    high_nodes = nodes.where(is_high)

    # The subtree of a node is that of its smallest member's first step below all high nodes.
    top = high_nodes.select("high", "low", F.lit(True).alias("is_high"))
    paths = steps.where("depth > 0").join(top, ["high", "low"], "left")
    cells = paths.where("is_high IS NULL").groupBy("conv_id").agg(F.min_by(F.struct("high", "low"), "depth").alias("cell"))
    bits = bucket_bits(spark, n_nodes, _SHARD_NODES)
    shard = F.pmod(F.xxhash64("cell"), F.lit(1 << bits)).alias("shard")
    names = [part.split()[0] for part in _NODE.split(", ")]
    nothing = [F.lit(0).cast("long").alias(name) for name in ("more_children", "more_leaves", "more_saved")]
    low_nodes = nodes.where(~is_high).join(cells, "conv_id").select(*names, *nothing, shard)
    low = work.table(low_nodes.groupBy("shard").applyInPandas(
        lambda frame: _totals(frame), f"{_NODE}, {_TOTALS}"), "low")

    hanging = low.where("parent_conv_id IS NULL").groupBy(*_digest("parent_")).agg(
        F.count(F.lit(1)).alias("more_children"), F.sum("n_leaves").alias("more_leaves"),
        F.sum("saved_tokens").alias("more_saved"),
    ).withColumnsRenamed({"parent_high": "high", "parent_low": "low"})
    high = work.table(
        high_nodes.join(hanging, ["high", "low"], "left").select(
            *names, *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("more_children", "more_leaves", "more_saved")])
        .groupBy(F.lit(0).alias("all")).applyInPandas(lambda frame: _totals(frame), f"{_NODE}, {_TOTALS}"), "high")
    above = high.select(
        F.col("high").alias("parent_high"), F.col("low").alias("parent_low"), F.col("conv_id").alias("above"))
    whole = low.join(above, _digest("parent_"), "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "above")).select(*high.columns).union(high)
    hashes = nodes.select("high", "low", "ends_sha256")
    return whole.join(hashes, ["high", "low"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "high", "low")


def conversation_trie(turns: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """The trie of ``turns`` (conv_id, turn, role, text), after every conversation borrowed the head of its group's first one.

    Conversation c takes the first h turns of conversation ``c - c % group``, h being crc32(decimal c) % (``most`` + 1),
    then its own behind its first h.  The remainder has the sign of c.  Null roles and texts are empty; turns without a
    conversation id belong to none and are left out; repeated rows are turns of their own, and rows with
    equal turns go by role and text digest.  Other columns are not read.  An empty table gives no nodes.
    """
    work = WorkArea(turns.sparkSession, "prefix-trie")
    numbered = work.table(numbered_turns(turns), "turns")
    c = F.col("conv_id")
    rebuilt = rebuilt_turns(
        numbered, c - c % F.lit(group), F.crc32(c.cast("string").cast("binary")) % F.lit(most + 1), most)
    return prefix_trie(rebuilt, work)
