"""Conversation repair and the prefix trie against plain Python."""

import heapq
import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderline_kpi.llm import conversation_repair as repairs, prefix_trie
from orderline_kpi.llm.queries import QUERIES
from orderline_kpi.sources.scratch import WorkArea
from llm_fixtures import package_for_workers  # noqa: F401

SPACES = " \t\n\v\f\r"
EDGE_TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Hello!"),
    (2, None, None, None), (2, 0, "user", ""), (2, 0, "user", "tie"), (2, 0, "user", "tie"), (2, 7, "tool", "x"),
    (None, 1, "user", "no conversation."), (None, None, "assistant", "nor a turn"), (3, 5, "", "no role"),
    (4, 1, "umbrella", " "), (4, 2, "User", "日本。 \U0001f600"), (4, -3, "assistant", "first \n. \t"),
    (-101, 1, "user", "negative."), (-100, 1, "user", "head."), (100, 1, "user", "Hello?"), (100, 2, "assistant", "x " * 40_000),
    (101, 1, "user", "mine"), (101, 2, "assistant", "yours."), (102, 9, "system", "a"), (6, 4, "user", "Only row."), ((1 << 62) + 1, (1 << 61) + 1, "user", "far."),
]


@pytest.fixture
def conversations(spark):
    """Conversations with extra columns whose names the operators use themselves."""
    def make(rows):
        return spark.createDataFrame(
            [(*row, "extra", -1, "x", True) for row in rows],
            "conv_id long, turn long, role string, text string, digest string, depth int, copy string, dropped boolean",
        ).repartition(3)

    return make


def some_turns(seed, n_convs=120):
    """Conversations with every fault, copies, shared heads and rows that repeat."""
    rng = random.Random(seed)
    texts = ["One.", "Two?", "three", "", " \t", "Four! ", "Five..", "six\n"]
    rows = []
    for conv in range(n_convs):
        known = [row for row in rows if row[0] == conv - 1]
        if known and rng.random() < 0.3:
            rows += [(conv, *row[1:]) for row in known[:rng.randint(1, len(known))]]
            continue
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]) if rng.random() < 0.3 else (
                "user", "assistant")[turn % 2]
            rows.append((conv if rng.random() < 0.98 else conv + 300, turn if rng.random() < 0.95 else turn + 3, role, rng.choice(texts)))
    return rows


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        from hashlib import md5
        tie = md5(f"{role}\0{text}".encode()).hexdigest()
        if draw == 4:
            role = "user"
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        out[conv] += [(turn is not None, turn, tie, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    for own in out.values():
        own.sort(key=lambda row: (row[0], row[1] or 0, row[2]))
    return out


def cheapest(rows):
    """Cost, letters and lines of the best repair, by search over all edits; ``rows``: fault, role, text."""
    open_ = [(0, "", 0, "", ())]
    while True:
        cost, letters, at, initials, lines = heapq.heappop(open_)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, letters, "\n".join(lines)

        def go(more, letter, read, initial="", line=None):
            after = initials + initial
            if re.fullmatch("s?(ua)*u?", after):
                heapq.heappush(open_, (cost + more, letters + letter, at + read, after, lines + ((line,) if line is not None else ())))

        for role in ("user", "assistant"):
            go(2, "I", 0, role[0], f"{role}:")
        if at < len(rows):
            fault, role, text = rows[at]
            go(3, "D", 1)
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[0] in "sua":
                    go(extra, "K", 1, role[0], f"{role}:{text}")
                for new in ("user", "assistant"):
                    go(2 + extra, "R", 1, new[0], f"{new}:{text}")


def plain_repair(rows):
    result = {}
    for conv, own in damaged(rows).items():
        seen, faults, pairs = set(), [], 0
        for _, _, _, role, text in own:
            bare = text.strip(SPACES)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        for a, b in zip(own, own[1:]):
            pairs += a[3][:1] + b[3][:1] not in ("su", "ua", "au")
        turns = [row[1] for row in own if row[0]]
        cost, letters, text = cheapest([(f, row[3], row[4]) for f, row in zip(faults, own, strict=True)])
        result[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), pairs, cost, letters,
            sha256(text.encode()).hexdigest())
    return result


def test_repair_equals_search_over_all_edits(spark, conversations, tables_dir):
    table = [tuple(row) for row in spark.read.parquet(f"{tables_dir}/conversations.parquet").collect()]
    for rows in (some_turns(5), EDGE_TURNS, table):
        got = {row[0]: tuple(row)[1:] for row in repairs.repair_conversations(repairs.damage(conversations(rows))).collect()}
        assert got == plain_repair(rows)


def test_letters_of_random_rows_in_blocks_of_any_size(monkeypatch):
    rng = random.Random(2)
    faults = ["", "blank", "duplicate", "truncated"]
    for _ in range(400):
        rows = [(rng.randrange(4), rng.randrange(4)) for _ in range(rng.randint(0, 6))]
        want = cheapest([(faults[f], "suax"[i], "") for f, i in rows])[:2]
        for block in (1, 2, 16):
            monkeypatch.setattr(repairs, "BLOCK", block)
            assert repairs.repair(bytes(4 * f + i for f, i in rows)) == want


def test_a_conversation_of_many_rows_takes_time_in_proportion():
    rng = random.Random(3)
    codes = bytes(rng.randrange(16) for _ in range(20_000))
    cost, letters = repairs.repair(codes)
    assert sum(letters.count(c) for c in "KRD") == len(codes) and 0 < cost <= 3 * len(codes)


def rebuilt(rows):
    """The rebuilt conversations, by definition."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort()
    result = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        head = own.get(conv - int(np.fmod(conv, 100)), [])[:h]
        result[conv] = [turn[2:] for turn in head + turns[h:]]
    return result


def plain_trie(convs):
    members = defaultdict(list)
    for conv, turns in convs.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    rows = []
    for node, own in members.items():
        subtree = [other for other in members if other[:len(node)] == node]
        childless = [other for other in subtree if not any(m[:-1] == other for m in members if m)]
        ends = sorted(conv for conv in own if len(convs[conv]) == len(node))
        rows.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            sum(m[:-1] == node for m in members if m), len(childless),
            sum((len(members[other]) - 1) * len(other[-1][1]) for other in subtree if other),
            sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=repr)


def same_but_order(rows):
    return sorted((tuple(row)[:8] for row in rows), key=repr)


def unambiguous(rows):
    """Without rows of one conversation and turn that differ: their order is by digest."""
    return list({(conv, turn): (conv, turn, role, text) for conv, turn, role, text in rows}.values())


def test_trie_equals_plain_prefixes(spark, conversations):
    for rows in (unambiguous(some_turns(6, 60)), unambiguous(EDGE_TURNS)):
        got = prefix_trie.conversation_trie(conversations(rows)).collect()
        assert same_but_order(got) == plain_trie(rebuilt(rows))


def test_any_cut_gives_the_same_trie(spark, conversations):
    rows = [(conv, turn, "user", f"t{turn if turn < 3 else conv % (turn + 2)}") for conv in range(60) for turn in range(conv % 7)]
    rows += [(conv, turn, "user", f"t{turn}") for conv in range(100, 130) for turn in range(4)]
    numbered = prefix_trie.numbered_turns(conversations(rows))
    plain = prefix_trie.rebuilt_turns(numbered, F.lit(-1).cast("long"), F.lit(0), 0)
    convs = defaultdict(list)
    for conv, _, role, text in rows:
        convs[conv].append((role, text))
    want = plain_trie(convs)
    for cut in (1, 2, 40, 1000):
        with WorkArea(spark, "trie-test") as work:
            assert same_but_order(prefix_trie.prefix_trie(plain, work, cut).collect()) == want


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(1 << 63, size=(2, n), dtype=np.uint64)
        table = prefix_trie.MinimalPerfectHash(high, low)
        assert sorted(table.slots(high, low).tolist()) == list(range(n))
        assert (table.slots(high, low + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.MinimalPerfectHash(np.ones(2, np.uint64), np.ones(2, np.uint64))


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op13_prefix_trie"])
def test_no_conversations(name, spark, conversations, tmp_path):
    conversations(EDGE_TURNS).where("false").write.parquet(str(tmp_path / "conversations.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
