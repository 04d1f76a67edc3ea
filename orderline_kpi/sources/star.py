"""Order lines out of a star schema (lineitem, orders, customer, part, nation, region).

``order_lines`` joins only the tables that the requested columns come from.  All joins
are left joins on the unique key of the other table: no line is ever lost or doubled,
and leaving a join out cannot change the rows.

No join carries a hint.  Spark broadcasts a table whose size, known from its files or
measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``; beyond that it
shuffles both sides, and adaptive execution splits partitions that a hot key makes
large.  Customer data is joined to orders, not to the lines, so that the longest table
is not shuffled for it; and orders come last, so that lines arrive partitioned by order,
which the distinct-order counts then need no further shuffle for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# The columns used of each table.  Naming the types spares a look at the
# files' footers for every query.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, "
    "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "ts timestamp_ntz, value double",
}


def read_table(spark: SparkSession, tables_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{tables_dir}/{name}.parquet")


def _hundredths(column: str) -> Column:
    """A two-decimal number as a whole number of hundredths."""
    return F.rint(F.col(column) * 100).cast("bigint")


def _scaled(units: Column, precision: int, scale: int) -> Column:
    """Whole units of 10**-scale as a decimal.

    Much cheaper per row than casting doubles, which go through text, and than decimal
    arithmetic; exact all the same.
    """
    unit = F.lit(f"0.{'1'.zfill(scale)}").cast(f"decimal({scale},{scale})")
    return (units.cast(f"decimal({precision},0)") * unit).cast(f"decimal({precision},{scale})")


def _sales() -> Column:
    return _scaled(_hundredths("l_extendedprice"), 12, 2)


def _profit() -> Column:
    revenue = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount"))
    cost = _hundredths("l_quantity") * _hundredths("p_retailprice")
    return _scaled(revenue - cost, 18, 4)


def _ship_real() -> Column:
    return F.date_diff("l_shipdate", "o_orderdate").cast("double")


def _ship_sched() -> Column:
    return F.substring("o_orderpriority", 1, 1).try_cast("double")


# Column -> (tables besides lineitem, expression).
_COLUMNS: dict[str, tuple[frozenset[str], Callable[[], Column]]] = {
    "order_id": (frozenset(), lambda: F.col("l_orderkey")),
    "ship_dt": (frozenset(), lambda: F.col("l_shipdate")),
    "sales": (frozenset(), _sales),
    "customer_id": (frozenset({"orders"}), lambda: F.col("o_custkey")),
    "order_dt": (frozenset({"orders"}), lambda: F.col("o_orderdate")),
    "ship_real": (frozenset({"orders"}), _ship_real),
    "ship_sched": (frozenset({"orders"}), _ship_sched),
    "late": (frozenset({"orders"}), lambda: (_ship_real() > _ship_sched()).cast("double")),
    "ship_mode": (frozenset({"orders"}), lambda: F.col("o_orderpriority")),
    "status": (frozenset({"orders"}), lambda: F.col("o_orderstatus")),
    "profit": (frozenset({"part"}), _profit),
    "category": (frozenset({"part"}), lambda: F.col("p_type")),
    "product": (frozenset({"part"}), lambda: F.col("p_name")),
    "segment": (frozenset({"orders", "customer"}), lambda: F.col("c_mktsegment")),
    "region": (
        frozenset({"orders", "customer", "nation", "region"}), lambda: F.col("r_name"),
    ),
}

FACT_COLUMNS = tuple(_COLUMNS)


def order_lines(
    spark: SparkSession, tables_dir: str, columns: Iterable[str] = FACT_COLUMNS
) -> DataFrame:
    """One row per line item with the given columns (all of them by default)."""
    columns = list(columns)
    needed = frozenset().union(*(_COLUMNS[column][0] for column in columns))

    def table(name: str) -> DataFrame:
        return read_table(spark, tables_dir, name)

    lines = table("lineitem")
    if "part" in needed:
        lines = lines.join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if "orders" in needed:
        orders = table("orders")
        if "customer" in needed:
            orders = orders.join(
                table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
            )
        if "region" in needed:
            orders = orders.join(
                table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
            ).join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return lines.select([_COLUMNS[column][1]().alias(column) for column in columns])


def event_lines(spark: SparkSession, tables_dir: str) -> DataFrame:
    """Events as timed sales; unlike orders they carry a time of day."""
    return read_table(spark, tables_dir, "events").select(
        F.col("ts").alias("order_dt"), _scaled(_hundredths("value"), 18, 2).alias("sales")
    )
