import numpy as np
import xxhash
from pyspark.sql import functions as F

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import simhash
from orderline_kpi.llm.queries import QUERIES
from orderline_kpi.sources.scratch import WorkArea
from llm_fixtures import documents, package_for_workers  # noqa: F401


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The index of the first member of each fingerprint's component, by comparing all pairs."""
    prints, root = np.array(prints, np.uint64), list(range(len(prints)))
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[:i] ^ prints[i]) <= 3):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_whole_table(spark, tables_dir):
    got = QUERIES["op3_simhash"](spark, tables_dir).toPandas().sort_values("doc_id")
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet").toPandas().sort_values("doc_id")
    sample = slice(0, None, 7)
    assert [f"{plain_fingerprint(t):016x}" for t in docs["text"][sample]] == got["fingerprint"][sample].tolist()
    ids = docs["doc_id"].tolist()
    roots = plain_components([int(x, 16) for x in got["fingerprint"]])
    assert [ids[r] for r in roots] == got["component_id"].tolist()


def test_edge_rows(documents):
    rows = simhash.near_duplicates(documents(*EDGE_ROWS), ["doc_id", "text"]).collect()
    assert len(rows) == len(EDGE_ROWS)
    for row in rows:
        assert row["fingerprint"] % 2**64 == plain_fingerprint(row["text"])
    empty = [row for row in rows if not (row["text"] or "").split()]
    assert {row["component_id"] for row in empty} == {1} and len(empty) == 4


def test_every_pair_of_three_bits_is_found_in_small_blocks_too(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(1 << 63, size=6, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for centre in centres:
        for _ in range(60):
            flipped = int(centre)
            for bit in rng.choice(64, rng.integers(1, 4), replace=False):
                flipped ^= 1 << int(bit)
            prints.add(flipped)
    prints = sorted(prints)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fingerprint long")
    expected = plain_components(prints)
    for block in (8, 2048):
        links = simhash.links(frame, WorkArea(spark, "test"), block=block).collect()
        root = list(range(len(prints)))
        at = {int(np.uint64(p).view(np.int64)): k for k, p in enumerate(prints)}
        for a, b in links:
            x, y = root[at[a]], root[at[b]]
            root = [min(x, y) if r in (x, y) else r for r in root]
        assert root == expected


def test_one_row_of_each_group_stays(documents):
    text = " ".join(f"w{k}" for k in range(400))
    docs = documents((5, text), (3, text), (3, text), (8, text + " tail"), (4, "something else entirely"), (None, "no id"), (6, None), (7, ""))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((row["doc_id"] or 0, row["text"]) for row in kept.collect() if row["text"]) == [
        (0, "no id"), (3, text), (4, "something else entirely")]
    assert kept.count() == 4


def test_a_long_list_costs_rows_in_proportion(spark):
    rng = np.random.default_rng(12)
    # All in one list of four positions, and many of them in one of five.
    low = np.unique(rng.integers(1 << 32, size=50_000, dtype=np.uint64))
    low = np.unique(np.r_[low, low[:300] ^ np.uint64(0b10010001), rng.integers(1 << 24, size=9000, dtype=np.uint64)])
    prints = (np.uint64(0xABCD1234) << np.uint64(32)) | low
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint long")
    with WorkArea(spark, "test") as work:
        lists = simhash._lists(frame, work, 3, 2048)
        sizes = lists.groupBy("mask", "value").count()
        assert sizes.agg(F.max("count")).first()[0] <= 2048
        assert lists.count() < 2 * 14 * len(prints)
        found = {tuple(sorted(np.array(row, np.int64).view(np.uint64).tolist())) for row in simhash.links(frame, work).collect()}
    for a, b in found:
        assert (a ^ b).bit_count() <= 3
    root = {int(p): int(p) for p in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in found:
        root[find(a)] = find(b)
    # All pairs by flipping up to three of the bits.
    flips = [1 << i for i in range(32)]
    flips += [a ^ b for a in flips for b in flips if a < b]
    known = set(prints.tolist())
    for p in prints[::40].tolist():
        assert all(find(p) == find(p ^ f) for f in flips if p ^ f in known)
    assert all(find(int(p)) == find(int(p) ^ 0b10010001) for p in prints if int(p) ^ 0b10010001 in known)


def test_finer_masks_hold_every_near_pair():
    rng = np.random.default_rng(13)
    for mask in simhash.key_masks():
        while masks := simhash.finer_masks(mask, 3):
            assert all(m & mask == mask and m != mask for m in masks) and len(masks) == 4
            for _ in range(20):
                free = [bit for bit in range(64) if not mask >> bit & 1]
                flip = sum(1 << int(bit) for bit in rng.choice(free, 3, replace=False))
                assert any(not flip & m for m in masks)
            mask = masks[int(rng.integers(4))]
