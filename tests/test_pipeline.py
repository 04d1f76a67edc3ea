"""Raw CSV to reports, and where working tables go."""

from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderline_kpi import __main__ as command
from orderline_kpi import run_pipeline
from orderline_kpi.plans.queries import QUERIES
from orderline_kpi.plans.reports import BASE, DERIVED
from orderline_kpi.sources import order_lines, scratch_path
from orderline_kpi.sources.raw_csv import stage_raw


@pytest.fixture(scope="module")
def raw(spark, tables_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "csv")
    stage_raw(order_lines(spark, tables_dir), path)
    return path


def test_reports_equal_the_queries_on_the_tables(spark, tables_dir, raw, tmp_path):
    reports = run_pipeline(
        spark, raw, str(tmp_path / "curated"), str(tmp_path / "reports"), late_risk=False
    )
    assert set(reports) == set(BASE) | set(DERIVED) | {"profile", "schema", "preview"}
    n_lines = spark.read.parquet(f"{tables_dir}/lineitem.parquet").count()
    assert reports["profile"].first().asDict() == {"row_count": n_lines, "column_count": 15}
    assert {row.column_name for row in reports["schema"].collect()} >= {"order_dt", "sales", "order_id"}
    assert reports["preview"].count() == 5 and reports.model is None
    assert not reports.skipped
    for name in ("monthly_trend", "product_top10_profit", "regional_sales_share"):
        expected = QUERIES[name](spark, tables_dir).toPandas()
        key = expected.columns[0]
        for table in (reports[name], spark.read.parquet(str(tmp_path / "reports" / name))):
            # Doubles out of a CSV here, decimals there: sums differ in the last digits.
            pd.testing.assert_frame_equal(
                table.toPandas().sort_values(key, ignore_index=True),
                expected.sort_values(key, ignore_index=True),
                check_like=True, check_exact=False, rtol=1e-12,
            )


def test_command(spark, raw, tmp_path, capsys):
    command.main([raw, str(tmp_path / "curated"), str(tmp_path / "reports")])
    shown = capsys.readouterr().out
    assert "monthly_trend" in shown and "areaUnderROC" in shown
    assert spark.read.parquet(str(tmp_path / "reports" / "late_risk_predictions")).count() > 0


def test_the_model_is_returned_and_saved(spark, raw, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel

    reports = run_pipeline(spark, raw, str(tmp_path / "curated"), str(tmp_path / "reports"))
    counts = {row.split: row.row_count for row in reports["late_risk_split_counts"].collect()}
    assert counts["test"] == reports["late_risk_predictions"].count() and counts["train"] > counts["test"]
    folder = str(tmp_path / "reports" / "late_risk_model")
    model = LogisticRegressionModel.load(f"{folder}/model")
    assert model.coefficients == reports.model.model.coefficients
    assert PipelineModel.load(f"{folder}/features").stages[0].labelsArray == reports.model.features.stages[0].labelsArray


@pytest.mark.parametrize("form", ["CA-{}", "{}.0"])
def test_ids_of_any_form_are_counted(spark, raw, tmp_path, form):
    prefix, suffix = form.split("{}")
    text = spark.read.csv(raw, header=True, encoding="ISO-8859-1").limit(3000)
    for name in ("Order Id", "Customer Id"):
        text = text.withColumn(name, F.concat(F.lit(prefix), F.col(name), F.lit(suffix)))
    text.write.csv(str(tmp_path / "ids"), header=True, encoding="ISO-8859-1")
    reports = run_pipeline(spark, str(tmp_path / "ids"), str(tmp_path / "curated"))
    row, written = reports["summary_statistics"].first(), spark.read.csv(str(tmp_path / "ids"), header=True)
    expected = written.agg(F.countDistinct("Order Id"), F.countDistinct("Customer Id")).first()
    assert (row.total_orders, row.total_customers) == tuple(expected) and row.total_orders > 100
    assert reports["late_risk_auc"].first().value > 0.9
    reports.model.close()


def test_missing_optional_columns_are_skipped(spark, raw, tmp_path):
    slim = spark.read.csv(raw, header=True).drop("Customer Segment", "Order Status", "Order Region")
    slim.write.csv(str(tmp_path / "slim"), header=True)
    reports = run_pipeline(spark, str(tmp_path / "slim"), str(tmp_path / "curated"))
    assert {
        "customer_segment", "order_status_distribution", "order_status_share",
        "regional_performance", "regional_bubble", "regional_sales_share", "late_risk",
    } == set(reports.skipped)
    assert reports["monthly_trend"].count() > 0


def session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)))


def test_working_tables_go_to_the_shared_folder():
    given = {"spark.checkpoint.dir": "hdfs://somewhere/work/", "spark.sql.warehouse.dir": "hdfs://warehouse"}
    path = scratch_path(session(**given), "train")
    assert path.startswith("hdfs://somewhere/work/train-")
    assert path != scratch_path(session(**given), "train")


def test_or_to_the_warehouse():
    assert scratch_path(session(**{"spark.sql.warehouse.dir": "hdfs://warehouse"}), "train").startswith(
        "hdfs://warehouse/_work/train-")
