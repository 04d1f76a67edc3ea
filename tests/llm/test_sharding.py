from collections import Counter
from zlib import crc32

import pytest

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import sharding
from orderline_kpi.llm.queries import QUERIES
from llm_fixtures import documents, package_for_workers  # noqa: F401


def check(rows, n_shards):
    counts = Counter(row["shard"] for row in rows)
    sizes = [counts[k] for k in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1
    for shard in range(n_shards):
        assert sorted(row["slot"] for row in rows if row["shard"] == shard) == list(range(counts[shard]))


def test_whole_table(spark, tables_dir):
    rows = QUERIES["op1_sharding"](spark, tables_dir).collect()
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{tables_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, 8)
    for row in rows:
        raw = (texts[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(raw) + 1, crc32(raw))
        assert row["law"] == "rows" and row["grown_shard"] is None


def test_edge_rows_and_equal_rows(documents):
    rows = sharding.shard(documents(*EDGE_ROWS, *[(77, "again")] * 500), n_shards=5).collect()
    assert len(rows) == len(EDGE_ROWS) + 500
    check(rows, 5)


def test_same_shards_in_any_partitioning(documents):
    docs = documents(*[(k, f"text {k}") for k in range(400)])
    first, second = (
        sorted(sharding.shard(frame).collect()) for frame in (docs, docs.repartition(7, "text")))
    assert first == second


def test_one_more_shard_moves_few_rows(documents):
    docs = documents(*[(k, str(k)) for k in range(4000)])
    before, after = (
        {row["doc_id"]: row["shard"] for row in sharding.shard(docs, n, load_factor=1.25).collect()} for n in (8, 9))
    # A ninth of the rows has to move; a fresh deal would move eight ninths.
    assert sum(before[k] != after[k] for k in before) < 0.3 * len(before)


def test_a_bound_is_kept_and_overflow_goes_clockwise():
    placed = sharding.place([5, 0, 4], [0, 1, 2], [3, 3, 3])
    assert placed == [(0, 0, 0, 3), (2, 2, 0, 3), (0, 1, 3, 5), (2, 1, 3, 4)]
    with pytest.raises(ValueError):
        sharding.shard_bounds(10, 2, 0.5)
