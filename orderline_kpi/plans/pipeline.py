"""The whole batch: raw CSV -> curated Parquet -> all analyses -> late-delivery model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderline_kpi.operators.cleaning import clean, preview
from orderline_kpi.operators.late_risk import train_late_risk
from orderline_kpi.plans.reports import DERIVED, Reports, run_all
from orderline_kpi.schema import MissingColumnsError
from orderline_kpi.sources.curated import write_curated
from orderline_kpi.sources.raw_csv import profile, read_raw, schema_table


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    curated_path: str,
    reports_path: str | None = None,
    late_risk: bool = True,
) -> Reports:
    """Clean the CSV into the curated table and analyse that.

    The CSV is parsed once; every analysis scans just its columns of the Parquet table.
    With ``reports_path`` each result is written below it and read back, and the model is saved
    there; the working data of its training is deleted then.  Else the caller closes ``reports.model``.
    The session is used as it is: apply ``configure`` to it before.
    """

    def keep(name: str, table: DataFrame) -> DataFrame:
        if reports_path is None:
            return table
        path = f"{reports_path.rstrip('/')}/{name}"
        table.write.mode("overwrite").parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    raw = read_raw(spark, raw_path)
    lines = write_curated(clean(raw), curated_path)
    reports = run_all(lines, keep)
    reports.tables["profile"] = keep("profile", profile(lines, len(raw.columns)))
    reports.tables["schema"] = keep("schema", schema_table(lines))
    try:
        reports.tables["preview"] = keep("preview", preview(lines))
    except MissingColumnsError as missing:
        reports.skipped["preview"] = str(missing)
    for name in DERIVED.keys() & reports.tables.keys():
        reports.tables[name] = keep(name, reports[name])
    if late_risk:
        try:
            trained = train_late_risk(lines)
        except MissingColumnsError as missing:
            reports.skipped["late_risk"] = str(missing)
        else:
            reports.model = trained
            for name, table in (
                ("predictions", trained.predictions()), ("auc", trained.auc()), ("split_counts", trained.split_counts()),
            ):
                reports.tables[f"late_risk_{name}"] = keep(f"late_risk_{name}", table)
            if reports_path is not None:
                trained.save(f"{reports_path.rstrip('/')}/late_risk_model")
                trained.close()
    return reports
