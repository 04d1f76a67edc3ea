"""``spark-submit``-able batch: python -m orderline_kpi RAW CURATED REPORTS"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderline_kpi.plans.pipeline import run_pipeline
from orderline_kpi.plans.settings import configure


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderline_kpi", description=__doc__)
    parser.add_argument("raw", help="CSV file or folder, any path Hadoop can read")
    parser.add_argument("curated", help="folder for the cleaned order lines (Parquet)")
    parser.add_argument("reports", help="folder for the result tables (Parquet)")
    parser.add_argument("--no-late-risk", action="store_true", help="leave the model out")
    options = parser.parse_args(arguments)

    spark = configure(SparkSession.builder.appName("orderline-kpi").getOrCreate())
    reports = run_pipeline(
        spark, options.raw, options.curated, options.reports, late_risk=not options.no_late_risk
    )
    for name in reports:
        print(name)
        reports[name].show(24, truncate=False)
    for name, reason in reports.skipped.items():
        print(f"skipped {name}: {reason}")


if __name__ == "__main__":
    main()
