"""Every analysis as a query on the star-schema tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderline_kpi.operators import late_risk
from orderline_kpi.operators.cleaning import clean, preview
from orderline_kpi.operators.correlation import correlation_matrix
from orderline_kpi.operators.kpi import kpi
from orderline_kpi.plans.catalog import KPIS
from orderline_kpi.plans.reports import DERIVED
from orderline_kpi.plans.settings import configure
from orderline_kpi.schema import DATE_COLUMNS, NUMERIC_COLUMNS, RAW_COLUMNS
from orderline_kpi.sources.curated import read_curated, write_curated
from orderline_kpi.sources.raw_csv import profile, read_raw, schema_table, stage_raw
from orderline_kpi.sources.scratch import scratch_path
from orderline_kpi.sources.star import event_lines, order_lines

Query = Callable[[SparkSession, str], DataFrame]

CLEAN_COLUMNS = tuple(c.name for c in RAW_COLUMNS if c.name not in DATE_COLUMNS) + tuple(
    DATE_COLUMNS.values()
)
# All orders of the test tables are at midnight; their events have a time of day.
_ON_EVENTS = ("hourly_pattern", "weekday_pattern")


def _correlation_matrix(spark: SparkSession, tables_dir: str) -> DataFrame:
    return correlation_matrix(order_lines(spark, tables_dir, NUMERIC_COLUMNS))


def _kpi_query(name: str) -> Query:
    spec = KPIS[name]

    def query(spark: SparkSession, tables_dir: str) -> DataFrame:
        if name in _ON_EVENTS:
            return kpi(event_lines(spark, tables_dir), spec)
        lines = order_lines(spark, tables_dir, [*spec.plain_inputs, *spec.distinct_measures])
        if len(spec.distinct_measures) > 1:
            # In one pass several exact counts multiply the rows; apart, each joins and moves just what it counts.
            return kpi(lines, spec, separate_distinct=True)
        return kpi(lines, spec)

    return query


def _derived_query(name: str) -> Query:
    source, report = DERIVED[name]
    return lambda spark, tables_dir: report(_kpi_query(source)(spark, tables_dir))


def _staged_csv(spark: SparkSession, tables_dir: str) -> str:
    path = scratch_path(spark, "raw_csv")
    stage_raw(order_lines(spark, tables_dir), path)
    return path


def _ingest_csv_clean(spark: SparkSession, tables_dir: str) -> DataFrame:
    # Ids come out of a CSV as text; those of these tables are numbers.
    return clean(read_raw(spark, _staged_csv(spark, tables_dir))).withColumns(
        {name: F.col(name).cast("bigint") for name in ("order_id", "customer_id")}).select(*CLEAN_COLUMNS)


def _ingest_profile(spark: SparkSession, tables_dir: str) -> DataFrame:
    return profile(read_raw(spark, _staged_csv(spark, tables_dir)))


def _ingest_schema(spark: SparkSession, tables_dir: str) -> DataFrame:
    return schema_table(read_raw(spark, _staged_csv(spark, tables_dir), infer_schema=True))


def _curated_roundtrip(spark: SparkSession, tables_dir: str) -> DataFrame:
    path = scratch_path(spark, "curated")
    lines = order_lines(spark, tables_dir).withColumns(
        {name: F.col(name).cast("double") for name in NUMERIC_COLUMNS}
    )
    write_curated(lines, path)
    return read_curated(spark, path).select(*CLEAN_COLUMNS)


def _clean_preview(spark: SparkSession, tables_dir: str) -> DataFrame:
    return preview(
        order_lines(spark, tables_dir, ["order_dt", "sales", "profit", "late"]), ordered=True
    ).select(
        "order_dt", F.col("sales").cast("double").alias("sales"),
        F.col("profit").cast("double").alias("profit"), "late",
    )


def _rounded_deviation(spark: SparkSession, tables_dir: str) -> DataFrame:
    summary = _kpi_query("summary_statistics")(spark, tables_dir)
    return summary.withColumn("stddev_sales", F.round("stddev_sales", 6))


def _ml_dataset(spark: SparkSession, tables_dir: str) -> DataFrame:
    return late_risk.late_risk_dataset(
        order_lines(spark, tables_dir, late_risk.LATE_RISK_INPUTS)
    )


def _ml_split_counts(spark: SparkSession, tables_dir: str) -> DataFrame:
    return late_risk.split_counts(late_risk.with_split(_ml_dataset(spark, tables_dir)))


def _ml_category_index(spark: SparkSession, tables_dir: str) -> DataFrame:
    categories = _ml_dataset(spark, tables_dir).select(*late_risk.CATEGORICAL_FEATURES)
    return late_risk.category_index(late_risk.fit_features(categories), categories)


def _ml_features(spark: SparkSession, tables_dir: str) -> DataFrame:
    """The feature vectors, spelt out: numbers, set positions and length."""
    dataset = _ml_dataset(spark, tables_dir)
    features = late_risk.fit_features(dataset.select(*late_risk.CATEGORICAL_FEATURES))
    vectors = features.transform(dataset).select(
        "order_id", "label", F.unwrap_udt("features").alias("v")
    ).select("order_id", "label", "v.size", "v.indices", "v.values")
    n = len(late_risk.NUMERIC_FEATURES)
    # A vector is stored densely, without indices, only where that takes no more room.
    is_dense = F.col("indices").isNull()
    positions = F.when(is_dense, F.filter(
        F.transform("values", lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())).otherwise(F.col("indices"))

    def number(at: int) -> Column:
        stored = F.get("values", F.array_position("indices", at).cast("int") - 1)
        return F.when(is_dense, F.get("values", F.lit(at))).otherwise(F.coalesce(
            F.when(F.array_contains("indices", at), stored), F.lit(0.0)))

    return vectors.select(
        "order_id", "label",
        *[number(at).alias(name) for at, name in enumerate(late_risk.NUMERIC_FEATURES)],
        F.concat_ws(",", F.transform(
            F.filter(positions, lambda p: p >= n), lambda p: p.cast("string"))).alias("set_positions"),
        F.coalesce("size", F.size("values")).alias("width"),
    )


def _trained(spark: SparkSession, tables_dir: str) -> late_risk.LateRisk:
    return late_risk.train_late_risk(order_lines(spark, tables_dir, late_risk.LATE_RISK_INPUTS))


def _ml_predictions(spark: SparkSession, tables_dir: str) -> DataFrame:
    """Every line of the test side with its label and prediction.

    Within a week of the border between the labels it is up to the last iterations of the fit on which side a
    line falls; there the prediction is left open.
    """
    trained = _trained(spark, tables_dir)
    at_border = F.abs(F.col("ship_real") - F.col("ship_sched")) <= 7
    return trained.score(trained.test).select(
        "order_id", "label", at_border.alias("at_border"), F.when(~at_border, F.col("prediction")).alias("prediction"))


def _ml_auc(spark: SparkSession, tables_dir: str) -> DataFrame:
    return _trained(spark, tables_dir).auc().withColumn("value", F.round("value", 3))


def _configured(query: Query) -> Query:
    """The query on a session with the settings; these are the only callers that do not set them themselves."""
    return lambda spark, tables_dir: query(configure(spark), tables_dir)


QUERIES: dict[str, Query] = {name: _configured(query) for name, query in {
    "ingest_csv_clean": _ingest_csv_clean,
    "ingest_profile": _ingest_profile,
    "ingest_schema": _ingest_schema,
    "curated_roundtrip": _curated_roundtrip,
    "clean_preview": _clean_preview,
    **{name: _kpi_query(name) for name in KPIS},
    "summary_statistics": _rounded_deviation,
    "correlation_matrix": _correlation_matrix,
    **{name: _derived_query(name) for name in DERIVED},
    "ml_dataset": _ml_dataset,
    "ml_split_counts": _ml_split_counts,
    "ml_category_index": _ml_category_index,
    "ml_features": _ml_features,
    "ml_late_risk_predictions": _ml_predictions,
    "ml_late_risk_auc": _ml_auc,
}.items()}
