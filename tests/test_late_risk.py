"""The late-delivery model: data set, features, split, fit and score."""

import os

import pytest
from pyspark.sql import functions as F

from orderline_kpi import fit_features, late_risk_dataset, train_late_risk
from orderline_kpi.operators.late_risk import (
    LATE_RISK_INPUTS, category_index, split_counts, with_split,
)
from orderline_kpi.sources import order_lines

SCHEMA = (
    "order_id bigint, late double, ship_real double, ship_sched double, sales double, "
    "ship_mode string, category string, region string"
)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_lines_with_a_gap_are_dropped_but_not_for_want_of_an_order_id(spark):
    good = (1, 1.0, 3.0, 2.0, 9.5, "a", "x", "r")
    rows = [good, (None, *good[1:])]
    rows += [good[:i] + (None,) + good[i + 1:] for i in range(1, 8)]
    dataset = late_risk_dataset(frame(spark, *rows))
    assert dataset.count() == 2
    assert dict(dataset.dtypes)["label"] == "int"
    assert split_counts(with_split(dataset)).agg(F.sum("row_count")).first()[0] == 2


def test_index_goes_by_count_then_name_and_unseen_values_are_all_zero(spark):
    seen = late_risk_dataset(frame(
        spark,
        *[(1, 1.0, 3.0, 2.0, 9.5, mode, "x", "r") for mode in ("b", "c", "c", "a")],
    ))
    features = fit_features(seen)
    index = {
        (r.feature, r.value): r.category_index for r in category_index(features, seen).collect()
    }
    assert [index["ship_mode", v] for v in "cab"] == [0.0, 1.0, 2.0]
    other = late_risk_dataset(frame(spark, (2, 0.0, 1.0, 2.0, 5.0, "z", "x", "r")))
    vector = features.transform(other).first().features.toArray().tolist()
    assert vector == [1.0, 2.0, 5.0, 0.0, 0.0, 0.0, 1.0, 1.0]


def test_a_column_of_very_many_values_is_indexed(spark):
    modes = spark.range(10_600).selectExpr(
        "1 AS order_id", "1.0D AS late", "3.0D AS ship_real", "2.0D AS ship_sched", "9.5D AS sales",
        "concat('mode ', id) AS ship_mode", "'x' AS category", "'r' AS region")
    features = fit_features(late_risk_dataset(modes))
    assert len(features.stages[0].labelsArray[0]) == 10_600


def test_lines_without_an_order_id_fall_on_both_sides(spark):
    rows = [(None, float(k % 2), 3.0, 2.0, float(k), "a", "x", "r") for k in range(400)]
    lines = frame(spark, *rows)
    for table in (lines, lines.drop("order_id")):
        counts = {r.split: r.row_count for r in split_counts(with_split(late_risk_dataset(table))).collect()}
        assert 280 < counts["train"] < 360 and sum(counts.values()) == 400


def test_a_model_on_shuffled_labels_is_no_good(spark, tables_dir):
    lines = order_lines(spark, tables_dir, LATE_RISK_INPUTS)
    shuffled = lines.withColumn("late", F.pmod(F.xxhash64("order_id", "sales"), F.lit(2)).cast("double"))
    with train_late_risk(shuffled) as trained:
        assert trained.auc().first().value < 0.6


def test_nothing_is_left_of_the_stored_data(spark, tables_dir):
    lines = order_lines(spark, tables_dir, LATE_RISK_INPUTS)
    with train_late_risk(lines) as trained:
        folder = trained.work.path.removeprefix("file:")
        assert os.path.isdir(folder)
        assert trained.predictions().count() > 0
    assert not os.path.exists(folder)


def test_split_depends_on_the_order_alone(spark, tables_dir):
    dataset = late_risk_dataset(order_lines(spark, tables_dir, LATE_RISK_INPUTS))
    split = with_split(dataset)
    assert split.groupBy("order_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    counts = {r.split: r.row_count for r in split_counts(split).collect()}
    assert 0.78 < counts["train"] / (counts["train"] + counts["test"]) < 0.82
    shuffled = with_split(dataset.repartition(5, "sales"))
    assert {r.split: r.row_count for r in split_counts(shuffled).collect()} == counts
    other_seed = with_split(dataset, seed=7)
    assert split.exceptAll(other_seed).count() > 0
    with pytest.raises(ValueError):
        with_split(dataset, train_fraction=1.0)


def test_model_on_order_lines(spark, tables_dir):
    lines = order_lines(spark, tables_dir, LATE_RISK_INPUTS)
    first, second = train_late_risk(lines), train_late_risk(lines)
    counts = {
        r.split: r.row_count
        for r in split_counts(with_split(late_risk_dataset(lines))).collect()
    }
    predictions = first.predictions()
    assert predictions.count() == counts["test"]
    assert 0.99 <= first.auc().first().value <= 1.0
    assert first.features.transform(first.test).first().features.size == 3 + 16

    keys = ["order_id", "label", "prediction"]
    assert predictions.select(keys).exceptAll(second.predictions().select(keys)).count() == 0
    gap = max(
        abs(a - b) for a, b in zip(first.model.coefficients, second.model.coefficients)
    )
    assert gap < 1e-6 * max(map(abs, first.model.coefficients))


def test_model_without_the_measured_days(spark, tables_dir):
    lines = order_lines(spark, tables_dir, LATE_RISK_INPUTS)
    trained = train_late_risk(lines, numeric=("ship_sched", "sales"))
    assert trained.features.transform(trained.test).first().features.size == 2 + 16
    assert 0.4 < trained.auc().first().value < 0.7
