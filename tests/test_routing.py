import pytest
from pyspark.sql import functions as F

from shardsmith.operators.routing import route_lookup, route_table, shard_grid, shard_partition, shard_skew


def test_route_table_16(spark):
    rows = route_table(spark, 16, limit=2000).orderBy("slot").collect()
    assert [r.route for r in rows] == [str(i) for i in range(10)] + ["19", "29", "39", "49", "59", "69"]
    assert [r.bucket for r in rows] == list(range(5, 16)) + [0, 1, 2, 3, 4]


def test_route_table_8_slot_is_not_bucket(spark):
    rows = route_table(spark, 8, limit=100).orderBy("slot").collect()
    assert [r.route for r in rows] == [str(i) for i in range(8)]
    assert [r.bucket for r in rows] == [5, 6, 7, 0, 1, 2, 3, 4]


def test_route_table_33_reports_missing(spark):
    with pytest.raises(ValueError) as e:
        route_table(spark, 33, limit=10**6, most=10**6)
    msg = str(e.value)
    assert "only 16 of 33" in msg and "missing buckets" in msg


def test_route_lookup_unknown_route_fails(spark):
    table = route_table(spark, 8, limit=100)
    ok = spark.createDataFrame([("3",), ("7",)], "r string")
    assert sorted(r.slot for r in route_lookup(ok, "r", table).collect()) == [3, 7]
    bad = spark.createDataFrame([("3",), ("99",)], "r string")
    with pytest.raises(Exception, match="unknown route: 99"):
        route_lookup(bad, "r", table).collect()


def test_shard_partition_pid_equals_shard(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 5).cast("int").alias("_shard"))
    out = shard_partition(df, 5).select("_shard", F.spark_partition_id().alias("pid")).distinct().collect()
    assert all(r._shard == r.pid for r in out) and len(out) == 5


def test_shard_partition_rejects_out_of_range(spark):
    df = spark.createDataFrame([(9,)], "_shard int")
    with pytest.raises(Exception, match="shard outside"):
        shard_partition(df, 8).collect()


def test_grid_and_skew(spark):
    per = spark.createDataFrame([(1, 10), (3, 30)], "shard int, docs bigint")
    grid = shard_grid(spark, 4, per)
    assert sorted((r.shard, r.docs) for r in grid.collect()) == [(0, 0), (1, 10), (2, 0), (3, 30)]
    sk = shard_skew(grid).first()
    assert (sk.shards, sk.max_docs, sk.avg_docs, sk.ratio) == (4, 30, 10.0, 3.0)
