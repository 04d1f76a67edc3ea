"""Pearson correlation of all pairs of numeric columns, in one pass over the lines."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, functions as F

from orderline_kpi.schema import NUMERIC_COLUMNS, MissingColumnsError


def _text(value: str) -> str:
    """A string as SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def correlation_matrix(
    lines: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, digits: int = 3
) -> DataFrame:
    """One row ``(col_a, col_b, r)`` per cell of the matrix.

    Uses those of ``columns`` that the table has, at least two.  Each pair counts the
    rows where both values are present; NaN counts as missing.  ``r`` is null if either
    column is constant on those rows (``corr`` would fail there under ANSI arithmetic).

    Every line becomes one narrow row for each pair it has both values of, and these are combined before the
    shuffle: a task sends one row of moments per pair, n(n+1)/2 at most, whichever values are missing.
    """
    present = [column for column in columns if column in lines.columns]
    if len(present) < 2:
        raise MissingColumnsError(
            "correlation_matrix", [c for c in columns if c not in present]
        )
    null = F.lit(None).cast("double")
    values = lines.select(
        [F.nanvl(F.col(c).cast("double"), null).alias(f"v{i}") for i, c in enumerate(present)]
    )
    size = len(present)
    pairs = ", ".join(
        f"{i * size + j}, v{i}, v{j}" for i, j in combinations_with_replacement(range(size), 2))
    upper = (
        values.select(F.expr(f"stack({size * (size + 1) // 2}, {pairs}) AS (slot, a, b)"))
        .where("a IS NOT NULL AND b IS NOT NULL")
        .groupBy("slot")
        .agg(
            F.covar_pop("a", "b").alias("cov"),
            *[F.var_pop(side).alias(f"var_{side}") for side in ("a", "b")],
            *[(F.min(side) < F.max(side)).alias(f"varies_{side}") for side in ("a", "b")],
        )
        .select("slot", F.when(
            F.col("varies_a") & F.col("varies_b"),
            F.try_divide("cov", F.sqrt("var_a") * F.sqrt("var_b")),
        ).alias("r"))
    )
    # One map of at most one entry per pair, so that every cell shows up, also that of a
    # pair without a single common row.
    cells = ", ".join(
        f"struct({_text(x)} AS col_a, {_text(y)} AS col_b, r[{min(i, j) * size + max(i, j)}] AS r)"
        for i, x in enumerate(present) for j, y in enumerate(present)
    )
    # Other than round, this keeps the sign of a small negative r.
    rounded = F.rint(F.col("r") * 10**digits) / 10**digits
    return (
        upper.agg(F.map_from_entries(F.collect_list(F.struct("slot", "r"))).alias("r"))
        .select(F.expr(f"inline(array({cells}))"))
        .select("col_a", "col_b", rounded.alias("r"))
    )
