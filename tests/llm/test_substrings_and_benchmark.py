import random

from pyspark.sql import functions as F

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import decontaminate, packing, substring_dedup
from llm_fixtures import documents, package_for_workers  # noqa: F401

import numpy as np
import pandas as pd


WORDS = [f"word{k}" for k in range(5000)]


def plain_kept(rows, window):
    """The words that stay, by looking up every window."""
    first, kept = {}, {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for at in range(len(words) - window + 1):
            first.setdefault(tuple(words[at:at + window]), (doc, at))
    for doc, text in rows:
        words, gone = (text or "").encode().split(), set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at:at + window])] < (doc, at):
                gone.update(range(at, at + window))
        kept[doc] = b" ".join(word for k, word in enumerate(words) if k not in gone).decode()
    return kept


def test_repeats_of_every_kind_equal_brute_force(documents):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(12)]
    passages = [rng.choices(words, k=rng.randint(3, 30)) for _ in range(8)]
    rows = []
    for doc in range(150):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts += rng.choice(passages) if rng.random() < 0.6 else rng.choices(words, k=rng.randint(1, 9))
        rows.append((doc, " ".join(parts)))
    rows += [(900 + k, rows[3][1]) for k in range(5)]
    for window in (2, 6, 10):
        got = {row["doc_id"]: row["kept"] for row in substring_dedup.remove_repeats(documents(*rows), window).collect()}
        assert got == plain_kept(rows, window)


def test_packed_columns_come_back():
    rng = np.random.default_rng(1)
    columns = [rng.integers(1 << 32, size=1000, dtype=np.uint64).astype(np.uint32), np.sort(rng.integers(-(1 << 60), 1 << 60, 1000)),
               rng.integers(256, size=1000).astype(np.uint8)]
    bucket = rng.integers(7, size=1000).astype(np.int16)
    rows = packing.pack(bucket, columns, [False, True, False])
    for number, own in rows.groupby("bucket"):
        for got, column in zip(packing.unpack(own, [np.uint32, np.int64, np.uint8], [False, True, False]), columns, strict=True):
            assert (got == column[bucket == number]).all()
    assert packing.pack(bucket[:0], [c[:0] for c in columns], [False, True, False]).empty
    assert all(len(c) == 0 for c in packing.unpack(pd.DataFrame({"entries": [], "packed": []}), [np.uint32], [False]))


def test_matches_in_blocks_and_near_ones(spark, documents):
    docs = documents(*EDGE_ROWS, (60, "zz alpha beta gamma delta zz"), (61, "alpha gamma zz beta delta"), (62, "alpha beta"))
    items = spark.createDataFrame([(1, "Alpha, beta gamma? delta"), (2, None), (3, "nowhere at all")], "item_id long, text string")
    for block in (1, 1000):
        found = decontaminate.Decontaminator(docs, items, window=4, slop=1, terms_per_block=block)
        matches = found.phrase_matches().select("id", "start", "size").collect()
        assert [tuple(row) for row in matches] == [(60, 1, 4)]
        assert {row["id"] for row in found.proximity_matches().collect()} == {60, 61}
        kept = found.clean_documents(docs)
        assert kept.columns == docs.columns and kept.count() == docs.count() - 1
        assert kept.where(F.col("doc_id") == 60).isEmpty()


def test_no_items(spark, documents):
    docs = documents(*EDGE_ROWS)
    none = decontaminate.Decontaminator(docs, spark.createDataFrame([], "item_id long, text string")).documents()
    assert none.count() == len(EDGE_ROWS) and none.where("n_hit > 0").isEmpty()


def test_buckets_grow_with_the_entries(spark, setting):
    setting("spark.sql.shuffle.partitions", "8")
    assert [packing.bucket_bits(spark, n, 1000) for n in (0, 8000, 8001, 1 << 30)] == [3, 3, 4, 21]
    setting("spark.sql.shuffle.partitions", "40000")
    assert packing.bucket_bits(spark, 0, 1000) == 16
    hashes = np.random.default_rng(1).integers(1 << 63, size=1000, dtype=np.uint64) * np.uint64(2)
    place = [np.zeros(1000, np.int64), np.zeros(1000, np.uint32), np.arange(1000, dtype=np.uint32)]
    sent = substring_dedup._Round([np.uint32], 10, True, 20, 3).send(hashes, [], place)
    assert set(sent["bucket"]) == set((hashes >> np.uint64(44)).tolist())


def test_a_passage_that_is_everywhere_fills_no_bucket(spark):
    rng = random.Random(5)
    passage = [f"p{k}" for k in range(25)]
    rows = [(doc, 0, " ".join(
        rng.choices(WORDS, k=rng.randint(5, 60)) + passage + rng.choices(WORDS, k=rng.randint(20, 60)))) for doc in range(6000)]
    texts = spark.createDataFrame(rows, "id long, tie long, text string")
    first = substring_dedup._Round([np.uint32], 10, True, 6, 4)
    sent = texts.mapInPandas(substring_dedup._probes(20, first), packing.SCHEMA).groupBy("bucket").sum("entries").toPandas()
    buckets, homes = (sent[sent["bucket"].lt(64) == here]["sum(entries)"] for here in (True, False))
    # 16 blocks of the passage in each document; nearly all go home at once.
    assert len(buckets) == 64 and buckets.max() < 3 * buckets.median()
    assert len(homes) == 16 and homes.sum() > 0.9 * 16 * 6000 and homes.max() < 1.5 * homes.median()


def test_answers_grow_with_buckets_and_not_with_documents(spark, setting, monkeypatch):
    rng = random.Random(6)
    rows = [(doc, " ".join(rng.choices(WORDS[:40], k=60) + [f"w{k}" for k in range(doc % 50, doc % 50 + 25)])) for doc in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gather = substring_dedup._by_document
    setting("spark.sql.shuffle.partitions", "4")
    counted = spark.sparkContext.accumulator(0)

    def counting(rows):
        counted.add(len(rows))
        return gather(rows)

    monkeypatch.setattr(substring_dedup, "_by_document", counting)
    substring_dedup.remove_repeats(docs).write.format("noop").mode("overwrite").save()
    # Two rounds; each bucket and each batch sends at most one row to each of 4 destinations.
    assert 0 < counted.value <= 2 * (4 + 16) * 4
