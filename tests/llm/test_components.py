"""Distributed union-find against plain union-find."""

import random

from pyspark.sql import functions as F

from orderline_kpi.llm import components
from orderline_kpi.sources.scratch import WorkArea


def plain_roots(links):
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in root}


def roots_of(spark, links, hub=components.HUB):
    with WorkArea(spark, "components-test") as work:
        found = components.connected_components(spark.createDataFrame(links, "a long, b long"), work, hub).collect()
    assert len({row["node"] for row in found}) == len(found)
    return {row["node"]: row["root"] for row in found}


def test_chains_stars_and_random_graphs(spark):
    rng = random.Random(9)
    for links in (
        [(k, k + 1) for k in range(40)] + [(107, k) for k in range(100, 130)],
        [(rng.randrange(300), rng.randrange(300)) for _ in range(220)], [(1, 2), (2, 1), (1, 2), (5, 5)], [],
    ):
        for hub in (3, 1000):
            assert roots_of(spark, links, hub) == plain_roots(links)


def test_links_of_a_hub_stay_where_they_are(spark, setting):
    rng = random.Random(10)
    links = [(15_000, k) for k in range(10_000)] + [(k, rng.randrange(20_000, 40_000)) for k in range(20_000, 40_000)]
    frame = spark.createDataFrame(links, "u long, v long").repartition(16)
    setting("spark.sql.shuffle.partitions", "16")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    with WorkArea(spark, "components-test") as work:
        known = components._with_least(frame, 1000, 10_000, work)
        sizes = known.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == len(links) and sizes.max() < 3 * sizes.median()
    assert roots_of(spark, links) == plain_roots(links)
