"""A third of all lines on one part and one order."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import rows_of, views_of
from orderline_kpi.plans.settings import configure


@pytest.fixture(scope="module")
def skewed_dir(spark, tables_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("orders", "part", "customer", "nation", "region"):
        spark.read.parquet(f"{tables_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    hot = F.pmod(F.hash("l_extendedprice", "l_shipdate"), F.lit(3)) == 0
    lines = spark.read.parquet(f"{tables_dir}/lineitem.parquet").withColumns({
        "l_partkey": F.when(hot, 7).otherwise(F.col("l_partkey")),
        "l_orderkey": F.when(hot, 11).otherwise(F.col("l_orderkey")),
    })
    lines.repartition(16).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name, split_keys", [
    ("monthly_trend", {"l_partkey", "l_orderkey"}),
    ("category_contribution", {"l_partkey"}),
    ("product_performance", {"l_partkey"}),
    ("regional_performance", {"l_partkey", "l_orderkey"}),
    ("summary_statistics", {"l_partkey", "l_orderkey"}),
])
def test_hot_keys_are_split_and_results_are_whole(name, split_keys, spark, skewed_dir, setting):
    configure(spark)
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8KB")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    result = contract.queries()[name](spark, skewed_dir)
    got = result.toPandas()
    expected = views_of(skewed_dir).execute(contract.oracle_sql()[name]).df()
    assert rows_of(got) == rows_of(expected)
    final = result._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    hot = {match for match in re.findall(r"Join\(skew=true\) \[(l_\w+)#", final)}
    assert hot == split_keys
