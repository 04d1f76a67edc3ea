"""Conversation structure repair by an auction algorithm for shortest paths.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  Its cheapest repair is a shortest path
through a lattice: a node is a number of rows read and a state of the pattern; arcs keep, rerole or
delete a row or insert an empty one, at integer costs.

**Auction.**  Every node has a price, never above the cost of any arc out of it plus the price behind that.  A path grows from its
origin.  If its last node's price is below the cheapest arc plus the price behind it, the price rises to that and the path is
contracted by its last arc; else the path is extended by such an arc.  When it reaches a node whose price
has converged, the prices of all its nodes have.  Arcs between converged nodes that cost just the difference of
the prices are tight; the repair is the path of tight arcs that is least as a text.

**Blocks.**  The lattice is cut every ``BLOCK`` rows.  The prices at the end of a block are all that the rows behind it mean
to it, so auctions run block by block, from the last one, and the path is traced block by block from the
first one.  Of a conversation a task holds one byte a row and the letters of its repair.  Blocks that come again
(most conversations are short and alike) are looked up.

Faults are found by Spark: a row is a duplicate if an earlier one agrees in the digest of role and text, which takes an
aggregation by conversation and digest.  Texts are streamed through the hash in the order of their turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import SPACE

BLOCK = 16
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

#: States of the pattern: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # by the only initial that may follow, but for the system row at the start
_INITIALS = "sua"  # a row's initial is its place here, or 3 for any other
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_GOAL = -1

#: Faults of a row, by the first that applies; a code is 4 * fault + initial.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

Arc = tuple[str, int, int]  # letter, cost, node behind


def _lattice(codes: bytes) -> list[list[Arc]]:
    """Arcs out of the nodes of a block; node ``4 * rows + state``, without any behind the last row.  Arcs are in the order of letters."""
    arcs: list[list[Arc]] = []
    for k, code in enumerate(codes):
        fault, initial = divmod(code, 4)
        for state in range(4):
            following = _NEXT[state]
            own = [(DELETE, DELETE_COST, 4 * (k + 1) + state), (INSERT, INSERT_COST, 4 * k + following)]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                fits = initial + 1 == following
                if fits or (state == START and initial + 1 == SYSTEM):
                    own.append((KEEP, more, 4 * (k + 1) + (following if fits else SYSTEM)))
                own.append((REROLE, REROLE_COST + more, 4 * (k + 1) + following))
            arcs.append(own)
    return arcs


#: Behind the last row only inserts are left; the pattern may end at the start and after an assistant row.
_ENDING: list[list[Arc]] = [
    ([("", 0, 4)] if state in (START, ASSISTANT) else []) + [(INSERT, INSERT_COST, _NEXT[state])] for state in range(4)]


class Auction:
    """Prices over a lattice whose last nodes (``ends``) have converged prices."""

    def __init__(self, arcs: list[list[Arc]], ends: list[int]) -> None:
        self.arcs = arcs
        # No node can do better than the cheapest end, so these prices are feasible.
        self.prices = [min(ends)] * len(arcs) + ends
        self.converged = [False] * len(arcs) + [True] * len(ends)

    def converge(self, origin: int) -> int:
        """Run the auction from ``origin``; its price is then its distance to the ends."""
        path = [origin]
        while not self.converged[path[-1]]:
            node = path[-1]
            bid, best = min((cost + self.prices[after], after) for _, cost, after in self.arcs[node])
            if self.prices[node] < bid:
                self.prices[node] = bid
                if len(path) > 1:
                    path.pop()
            else:
                path.append(best)
        # Each price on the path equals its arc plus the next price, up to one that is a distance.
        for node in path:
            self.converged[node] = True
        return self.prices[origin]

    def trace(self, origin: int) -> tuple[str, int]:
        """The letters of the least path of tight arcs from ``origin``, and the end it reaches (from 0)."""
        letters, node = [], origin
        self.converge(node)
        while node < len(self.arcs):
            # Arcs that look tight may lead to a price that still rises.
            letter, _, node = next(arc for arc in sorted(self.arcs[node]) if (
                self.prices[node] == arc[1] + self.prices[arc[2]] == arc[1] + self.converge(arc[2])))
            letters.append(letter)
        return "".join(letters), node - len(self.arcs)


@lru_cache(maxsize=1 << 14)
def _solved(codes: bytes | None, ends: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """For each state before a block: distance, letters, state behind it.  ``codes`` None: behind the last row."""
    auction = Auction(_ENDING if codes is None else _lattice(codes), list(ends))
    return tuple((auction.converge(state), *auction.trace(state)) for state in range(4))


def repair(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the cheapest repair of the rows with these codes, of several the least text."""
    blocks = [codes[at:at + BLOCK] for at in range(0, len(codes), BLOCK)]
    last = _solved(None, (0,))
    before, base = [], 0
    ends = tuple(distance for distance, _, _ in last)
    for block in reversed(blocks):
        # Prices relative to the cheapest, so that like blocks are alike wherever they stand.
        lowest = min(ends)
        base += lowest
        before.append(tuple(end - lowest for end in ends))
        ends = tuple(distance for distance, _, _ in _solved(block, before[-1]))
    letters, state = [], START
    for block, relative in zip(blocks, reversed(before), strict=True):
        _, part, state = _solved(block, relative)[state]
        letters.append(part)
    letters.append(last[state][1])
    return base + ends[START], "".join(letters)


def _filled(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, tie, copy, role, text, dropped`` of every row after the damage that its conversation and turn draw.

    crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes its full stops, 3 repeats it, 4 makes it the user's.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _filled(F.col("role")).alias("role"), _filled(F.col("text")).alias("text"),
        (F.crc32(F.concat(_filled(F.col("conv_id")), F.lit(":"), _filled(F.col("turn"))).cast("binary")) % 20).alias("draw"))
    tie = F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"))
    return rows.withColumn("tie", tie).withColumn(
        "copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    ).select(
        "conv_id", "turn", "tie", "copy", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("draw") == 0).alias("dropped"))


_ORDER = ("present", "turn", "tie", "copy")


def with_codes(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, tie, copy, code`` of each row: fault and initial as one number, null for a dropped row."""
    bare = F.regexp_replace("text", f"^{SPACE}|{SPACE}$", "")
    alone = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(*".!?"), TRUNCATED).otherwise(SOUND)
    initial = F.when(F.col("role") == "", 3).otherwise(
        F.coalesce(F.nullif(F.instr(F.lit(_INITIALS), F.left("role", F.lit(1))), F.lit(0)) - 1, F.lit(3)))
    # Texts stay behind: what is joined is a few numbers a row.
    rows = rows.select(
        "conv_id", "turn", "tie", "copy", "dropped", alone.alias("alone"), initial.alias("initial"),
        F.struct(F.col("turn").isNotNull().alias("present"), *_ORDER[1:]).alias("place"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
                ).alias("digest"))
    firsts = rows.where("NOT dropped").groupBy("conv_id", "digest").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("conv_id").alias("first_conv"), F.col("digest").alias("first_digest"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("digest") == F.col("first_digest"))
    seen = F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    fault = F.when(seen & (F.col("alone") != BLANK), DUPLICATE).otherwise(F.col("alone"))
    return rows.join(firsts, same, "left").select(
        "conv_id", "turn", "tie", "copy", F.when(~F.col("dropped"), fault * 4 + F.col("initial")).alias("code"))


class _Conversation:
    """What is known of one conversation while its rows go by, first their codes, then their texts."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.codes, self.letters = conv, bytearray(), None
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, turn: int | None, code: int, place: tuple) -> None:
        # Rows that are equal altogether have one place; Spark has seen none of them behind another.
        self.codes.append(4 * DUPLICATE + code % 4 if place == self.last and code // 4 != BLANK else code)
        self.last = place
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def solve(self) -> None:
        self.cost, self.letters = repair(bytes(self.codes))
        self.hash, self.at, self.state, self.first = hashlib.sha256(), 0, START, True

    def _put(self, line: str) -> None:
        self.hash.update((line if self.first else "\n" + line).encode())
        self.first = False

    def _insert(self) -> None:
        while self.letters[self.at:self.at + 1] == INSERT:
            self.state = _NEXT[self.state]
            self._put(f"{_ROLES[self.state]}:")
            self.at += 1

    def text(self, role: str, text: str) -> None:
        """The next row, to be edited as its letter says, behind what is inserted before it."""
        if self.letters is None:
            self.solve()
        self._insert()
        letter = self.letters[self.at]
        self.at += 1
        if letter != DELETE:
            keeps_system = letter == KEEP and role[:1] == "s"
            self.state = SYSTEM if keeps_system else _NEXT[self.state]
            self._put(f"{role if letter == KEEP else _ROLES[self.state]}:{text}")

    def row(self) -> tuple:
        if self.letters is None:
            self.solve()
        self._insert()
        faults = [code // 4 for code in self.codes]
        initials = [_INITIALS[code % 4:code % 4 + 1] for code in self.codes]
        legal = {("s", "u"), ("u", "a"), ("a", "u")}
        return (
            self.conv, 0 if self.low is None else self.high - self.low + 1 - self.turns,
            *[faults.count(fault) for fault in (BLANK, DUPLICATE, TRUNCATED)],
            sum(pair not in legal for pair in zip(initials, initials[1:], strict=False)),
            self.cost, self.letters, self.hash.hexdigest())


_STREAMED = ("conv_id", "turn", "tie", "copy", "code", "role", "text")
_RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current = None
    for batch in batches:
        done = []
        for conv, turn, tie, copy, code, role, text in zip(*(batch.column(name).to_pylist() for name in _STREAMED), strict=True):
            if current is None or conv != current.conv:
                if current is not None:
                    done.append(current.row())
                current = _Conversation(conv)
            if text is not None:
                current.text(role, text)
            elif code is not None:
                current.add(turn, code, (turn, tie, copy))
        yield _result(done)
    yield _result([current.row()] if current is not None else [])


def _result(rows: list[tuple]) -> pa.RecordBatch:
    fields = [part.split() for part in _RESULT.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Counts of faults, cost, ``audit`` and ``repaired_sha256`` for every conversation of ``rows``, as ``damage`` gives them.

    Rows are read by turn (null first), rows with one turn by the digest of role and text before the damage; a repeated row is a
    duplicate.  A null conversation id is a conversation of its own.  A role that is empty or begins with another letter
    than s, u or a fits nowhere.  A conversation of dropped rows only has zeros, an empty audit and the
    hash of nothing; an empty table gives an empty result.
    """
    # Of each conversation first all codes, then all texts.
    nothing = F.lit(None).cast("string")
    codes = with_codes(rows).select(*_STREAMED[:5], nothing.alias("role"), nothing.alias("text"), F.lit(0).alias("part"))
    texts = rows.where("NOT dropped").select(
        *_STREAMED[:4], F.lit(None).cast("int").alias("code"), "role", "text", F.lit(1).alias("part"))
    both = codes.union(texts).withColumn("present", F.col("turn").isNotNull())
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "part", *_ORDER)
    return ordered.select(*_STREAMED).mapInArrow(_streamed, _RESULT)
