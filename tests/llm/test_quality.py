import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from zlib import crc32

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import quality_model, quality_rules
from orderline_kpi.llm.queries import QUERIES
from llm_fixtures import documents, package_for_workers  # noqa: F401


def area(score, label):
    ranks = pd.Series(score).rank().to_numpy()
    ones = label.sum()
    return (ranks[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))


def test_held_out_documents_are_told_apart(spark, tables_dir):
    rows = QUERIES["op4_quality_classifier"](spark, tables_dir).toPandas()
    assert len(rows) == spark.read.parquet(f"{tables_dir}/documents.parquet").count()
    assert rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [crc32(str(k).encode()) % 3 == 1 for k in rows["doc_id"]]).all()
    labels = spark.read.parquet(f"{tables_dir}/labels.parquet").toPandas()
    held = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert area(held["score"], held["quality"].to_numpy()) > 0.97
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_trees_fit_what_no_line_separates_and_never_see_more_than_asked():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    trees = quality_model.fit_trees(x[:2000], y[:2000])
    assert ((trees.scores(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.93


@pytest.mark.parametrize("labels", [[], [1, 1], [0]])
def test_too_little_to_learn_from(labels):
    trees = quality_model.fit_trees(np.zeros((len(labels), 3)), np.array(labels, float))
    scores = trees.scores(np.ones((2, 3)))
    assert ((0 < scores) & (scores < 1)).all()


def test_edge_rows_are_scored(spark, documents):
    docs = documents(*EDGE_ROWS)
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (7, 1), (7, None), (9, 0), (9, 1), (None, 1)], "doc_id long, quality int")
    trees = quality_model.train(docs, labels)
    scores = quality_model.score(docs, trees).collect()
    assert len(scores) == len(EDGE_ROWS) and all(0 <= row["score"] <= 1 for row in scores)
    nothing = quality_model.score(docs.where("false"), quality_model.train(docs.where("false"), labels))
    assert nothing.count() == 0


def test_a_bad_host_takes_its_documents_along(spark, documents):
    good = " ".join(f"word{k}" for k in range(80))
    docs = documents(*[(k, good) for k in range(60)], source="fine").union(
        documents(*[(100 + k, "short") for k in range(30)], (130, good), source="bad")).union(
        documents((200, "short"), (201, good), source="small"))
    kept = {row["doc_id"]: row["kept"] for row in quality_rules.apply_rules(docs).collect()}
    assert all(kept[k] for k in range(60))
    assert not any(kept[k] for k in range(100, 131))
    # Of two documents one fails; the prior keeps the host.
    assert kept[201] and not kept[200]


def test_rules_keep_all_columns_of_edge_rows(documents):
    docs = documents(*EDGE_ROWS)
    ruled = quality_rules.apply_rules(docs)
    assert ruled.count() == len(EDGE_ROWS) and {"id", "lang", "kept", "n_words"} <= set(ruled.columns)
    assert ruled.where(F.col("text").isNull()).select("n_words", "kept").distinct().collect() == [(0, False)]


def hosts_of(spark, rows):
    return spark.createDataFrame([(str(k), n, f) for k, (n, f) in enumerate(rows)], "host string, n_docs long, n_failed long")


def test_prior_finds_the_spread_that_hosts_were_drawn_with(spark):
    rng = np.random.default_rng(1)
    sizes = rng.integers(5, 400, 3000)
    rates = rng.beta(2, 18, len(sizes))
    prior = quality_rules.host_prior(hosts_of(spark, [(int(n), int(rng.binomial(n, r))) for n, r in zip(sizes, rates)])).first()
    assert abs(prior["mean"] - 0.1) < 0.005 and abs(prior["spread"] - 1 / 21) < 0.006


def test_hosts_that_differ_by_chance_alone_are_not_suspect(spark):
    rng = np.random.default_rng(2)
    sizes = [30_000, *rng.integers(2, 800, 400).tolist()]
    verdicts = quality_rules.host_verdicts(
        hosts_of(spark, [(n, int(rng.binomial(n, 0.08))) for n in sizes]), max_rate=0.5)
    assert verdicts.where("suspect OR rejected").isEmpty()


@pytest.mark.parametrize("rows", [[(10, 9)], [(5, 5), (7, 7)], [(5, 0), (9, 0)], [(4, 2), (4, 2)]])
def test_hosts_without_a_spread_are_judged_alike(spark, rows):
    verdicts = quality_rules.host_verdicts(hosts_of(spark, rows), max_rate=0.5).collect()
    rate = sum(f for _, f in rows) / sum(n for n, _ in rows)
    assert all(row["shrunk_rate"] == row["least_rate"] == rate and not row["suspect"] and not row["rejected"] for row in verdicts)


def test_a_suspect_host_is_held_to_stricter_limits(documents):
    clean, brief = (" ".join(f"word{k}" for k in range(n)) for n in (150, 80))
    marked = " ".join(f"word{k} ###" for k in range(100))
    part = lambda source, first, fails: documents(
        *[(first + k, "short" if k < fails else clean) for k in range(200)],
        (first + 200, brief), (first + 201, marked), source=source)
    docs = part("suspect", 0, 60)
    for k in range(1, 12):
        docs = docs.union(part(f"fine{k}", 1000 * k, k % 3))
    kept = {row["doc_id"]: row["kept"] for row in quality_rules.apply_rules(docs).collect()}
    assert not any(kept[k] for k in range(60)) and all(kept[k] for k in range(60, 200))
    assert not kept[200] and not kept[201]
    assert all(kept[1000 * k + d] for k in range(1, 12) for d in range(2, 202))
