"""The raw order-line CSV: reading, profiling and staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderline_kpi.schema import DATE_COLUMNS, RAW_COLUMNS, RAW_DATE_FORMAT, RAW_ENCODING, raw_schema


def read_raw(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Read a CSV file or folder with a header line, keeping all its columns.

    By default only the header is looked at first, and the schema follows from it; a
    field that does not fit its type becomes null.  ``infer_schema=True`` lets Spark
    derive the types from the values, at the price of one more pass over the data.
    Files of one folder must have the same header.
    """
    reader = spark.read.options(header=True, encoding=RAW_ENCODING)
    if infer_schema:
        return reader.csv(path, inferSchema=True)
    headers = reader.csv(path).columns
    return reader.schema(raw_schema(headers)).csv(path, enforceSchema=False)


def profile(raw: DataFrame, n_columns: int | None = None) -> DataFrame:
    """One row: number of rows and of columns, or ``n_columns`` where ``raw`` is a stored form of the file."""
    return raw.agg(
        F.count("*").alias("row_count"),
        F.lit(n_columns or len(raw.columns)).alias("column_count"),
    )


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    described = [
        (position, field.name, field.dataType.simpleString())
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        described, "position int, column_name string, data_type string"
    )


def stage_raw(lines: DataFrame, path: str) -> None:
    """Write cleaned order lines as a raw CSV: original headers, encoding and dates."""
    text_from = {text: timestamp for text, timestamp in DATE_COLUMNS.items()}
    columns = [
        F.date_format(text_from[column.name], RAW_DATE_FORMAT).alias(column.header)
        if column.name in text_from
        else F.col(column.name).alias(column.header)
        for column in RAW_COLUMNS
    ]
    lines.select(columns).write.csv(path, header=True, encoding=RAW_ENCODING)
