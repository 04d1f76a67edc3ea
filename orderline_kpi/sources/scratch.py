"""Working tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"

_owned: ContextVar[list["WorkArea"] | None] = ContextVar("owned", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one in the warehouse.

    Both are storage that every executor reaches.
    """
    root = spark.conf.get(_SETTING, None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


class WorkArea:
    """A folder of its own for the working tables of one computation.

    ``close()``, or leaving a ``with`` block, deletes it with all tables in it; results
    that read them must have been used or written by then.  ``root`` replaces the
    session's shared folder.  An area made inside ``work_scope()`` ends with it.
    """

    def __init__(self, spark: SparkSession, label: str, root: str | None = None) -> None:
        self.spark = spark
        self.path = f"{(root or shared_root(spark)).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        owned = _owned.get()
        if owned is not None:
            owned.append(self)

    def file(self, name: str) -> str:
        """A new path in this area."""
        return f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` as Parquet and return the table read back.

        Several passes over the result then cost a pruned scan each, and a lost executor
        costs a re-read instead of a re-run of everything upstream.
        """
        path = self.file(name)
        df.write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> WorkArea:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


@contextmanager
def work_scope() -> Iterator[None]:
    """Deletes at its end all working tables made inside, by whichever operator.

    What an operator returns often reads such tables, so write or collect it inside::

        with work_scope():
            remove_repeats(docs).write.parquet(path)

    Scopes nest; an area belongs to the innermost one of its thread.
    """
    areas: list[WorkArea] = []
    outer = _owned.set(areas)
    try:
        yield
    finally:
        _owned.reset(outer)
        for area in areas:
            area.close()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the session's shared folder."""
    return WorkArea(spark, label).file(label)


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a working table of its own."""
    return WorkArea(df.sparkSession, label).table(df, label, partition_by)
