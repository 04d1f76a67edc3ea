"""Reading the text tables and splitting texts into words, for all operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words, as a Java regular expression.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers that start from now on import this package from where the driver has it.

    For a checkout that is on every machine or in local mode; ``--py-files`` does it otherwise.
    """
    environment = spark.sparkContext.environment
    root, known = str(Path(__file__).parents[2]), environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return spark


def filled(text: Column) -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text between runs of white space; none for an empty or null text."""
    return F.array_remove(F.split(filled(text), SPACE), "")


def groups_of(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, list[int], list[int]]]:
    """Whole groups of rows with equal numbers in ``keys``, from batches sorted by them.

    Yields frames with the first row and the end of each group in it.  What is held
    is a batch and the group that goes on behind it.
    """
    carried = None
    for batch in _with_end(batches):
        part = batch if carried is None else pd.concat([carried, batch], ignore_index=True)
        values = part[keys].to_numpy()
        begins = np.flatnonzero(np.r_[len(part) > 0, (values[1:] != values[:-1]).any(1)])
        if len(batch):
            # The last group may go on in the next batch.
            carried = part.iloc[begins[-1]:]
            yield part, begins[:-1].tolist(), begins[1:].tolist()
        else:
            yield part, begins.tolist(), np.r_[begins[1:], len(part)].tolist()


def _with_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches with rows, and an empty one that says that there are no more."""
    last = None
    for last in batches:
        if len(last):
            yield last
    if last is not None:
        yield last.iloc[:0]
