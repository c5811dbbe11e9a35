"""Physical-plan properties the design relies on (read from ``explain``)."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shardsmith.operators.documents import documents_from_table
from shardsmith.operators.routing import route_lookup, route_table
from shardsmith.operators.search import get_by_id, range_, search, term
from shardsmith.plans.build import IndexSpec, build_index, restore_snapshot, shard_layout


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # no "..." in scan metadata
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def customers(spark):
    from shardsmith.session import shared_dir

    dest = shared_dir(spark, "tests", "plans", unique=True)
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    build_index(spark, documents_from_table(cust, "c_custkey"), dest, IndexSpec("customer", 8))
    return restore_snapshot(spark, dest, "customer")


def test_publish_is_one_exchange_shared_by_dedup_and_writer(spark):
    staged = spark.createDataFrame(
        [("1", 0, 0, "{}", 2, 1), ("1", 0, 1, "{}", 2, 2), ("2", 3, 0, "{}", 2, 3)],
        "_id string, _shard int, _seq bigint, _source string, _bytes bigint, _hash bigint",
    )
    laid = shard_layout(staged, IndexSpec("x", 4), {0: 10, 3: 10})
    laid.write.format("noop").mode("overwrite").save()
    plan = _plan(laid)
    assert plan.count("Exchange") == 1 and "shufflepartitionidpassthrough" in plan
    assert plan.count("Sort [") == 1


def test_get_by_id_prunes_shard_folder_and_pushes_id(customers):
    plan = _plan(get_by_id(customers, 8, ["42"]))
    assert re.search(r"PartitionFilters: \[.*_shard", plan)
    assert re.search(r"PushedFilters: \[.*EqualTo\(_id,42\)", plan)


def test_search_prunes_columns_and_pushes_predicates(customers):
    q = search(customers, range_("c_acctbal", gte=1000.0, lt=5000.0) & term("c_mktsegment", "BUILDING"),
               columns=["c_custkey", "c_acctbal"])
    plan = _plan(q)
    assert "GreaterThanOrEqual(c_acctbal,1000.0)" in plan and "EqualTo(c_mktsegment,BUILDING)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "_source" not in read and set(x.split(":")[0] for x in read.split(",")) == {"c_custkey", "c_acctbal", "c_mktsegment"}


def test_topk_is_a_per_task_top_k(customers):
    q = search(customers, columns=["c_custkey", "c_acctbal"], sort=[F.desc("c_acctbal"), "c_custkey"], size=10)
    assert "TakeOrderedAndProject" in _plan(q)


def test_route_lookup_broadcasts_the_n_row_table(spark):
    table = route_table(spark, 8, limit=100)
    df = spark.range(1000).select((F.col("id") % 8).cast("string").alias("r"))
    assert "BroadcastHashJoin" in _plan(route_lookup(df, "r", table))


def test_multi_get_broadcasts_only_under_the_checked_bound(spark, customers):
    from shardsmith.operators.search import multi_get

    wanted = spark.createDataFrame([("1",), ("42",)], "_id string")
    small = multi_get(customers, 8, wanted, pushed_ids=1)
    assert "BroadcastHashJoin" in _plan(small) and small.count() == 2
    big = multi_get(customers, 8, wanted, broadcast_bytes=50, pushed_ids=1)
    initial = big._jdf.queryExecution().sparkPlan().toString()  # before AQE re-plans with run-time sizes
    assert "SortMergeJoin" in initial and big.count() == 2


def test_spread_narrow_only_spreads_big_narrow_scans(spark):
    from shardsmith.sources.tables import read_table

    slots = spark.sparkContext.defaultParallelism
    docs = read_table(spark, "/root/testdata/sf0.01/documents.parquet")  # one row group, > 1 MiB
    assert docs.rdd.getNumPartitions() == slots
    assert "monotonically_increasing_id" in docs._jdf.queryExecution().optimizedPlan().toString()
    nation = read_table(spark, "/root/testdata/sf0.01/nation.parquet")  # tiny: left as a bare scan
    assert "Repartition" not in nation._jdf.queryExecution().optimizedPlan().toString()
    assert docs.count() == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
