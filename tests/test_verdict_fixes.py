"""Inputs that once gave wrong answers: kept rows, honest rejects, long id lists, searches that go on."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shardsmith.operators.dedup import assign_bulks
from shardsmith.operators.documents import documents_from_lines, documents_from_table
from shardsmith.operators.report import shard_counts
from shardsmith.operators.routing import assign_shards, route_table
from shardsmith.operators.search import get_by_id
from shardsmith.plans.build import IndexSpec, build_index, compact_index, prepare, read_manifest, restore_snapshot, verify_snapshot


def test_bulks_keep_every_row_with_the_source_kept(spark):
    docs = assign_shards(documents_from_table(spark.read.parquet(f"{SF001}/orders.parquet"), "o_orderkey"), 8)
    got = assign_bulks(docs, 100, order=("_id",), partitions=7).toPandas()
    assert len(got) == docs.count()
    want = got.sort_values(["_shard", "_id"]).groupby("_shard").cumcount()
    assert (got["_rank"] == want.reindex(got.index)).all()


def test_text_after_an_object_is_refused(spark):
    lines = ['{"a":1}', ' {"a": 2 } ', '\t{"a":3}', '{"a":1}{"a":2}', '{"a":3} xyz', '{"a":1},{"a":2}', '{"a":1}] x', '{"a":1}} x', "[1,2]", "nope", "", "42", None]
    docs = documents_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    rows = prepare(docs, IndexSpec("x", 2)).select("_source", "_status").collect()
    assert sorted(r._source for r in rows if r._status == "accepted") == ['{"a":1}', '{"a":2}', '{"a":3}']
    assert sum(r._status == "rejected" for r in rows) == 10


def test_compaction_keeps_equal_copies(spark, scratch):
    lines = spark.range(501).select(F.to_json(F.struct((F.col("id") % 250).alias("a"))).alias("value"))
    spec = IndexSpec("copies", 2, dedup=False)
    build_index(spark, documents_from_lines(lines), scratch, spec)
    compact_index(spark, scratch, IndexSpec("copies", 2))
    assert restore_snapshot(spark, scratch, "copies").count() == 501
    assert read_manifest(spark, scratch, "copies").agg(F.sum("docs")).head()[0] == 501
    assert all(r.ok for r in verify_snapshot(spark, scratch, "copies").collect())


def test_get_by_id_takes_thousands_of_ids(spark):
    docs = assign_shards(documents_from_table(spark.read.parquet(f"{SF001}/orders.parquet"), "o_orderkey"), 8)
    ids = [r[0] for r in docs.select("_id").collect()]
    many = ids + [f"none{i}" for i in range(4000)]
    assert get_by_id(docs, 8, many).count() == len(ids)


def test_shard_counts_add_up_with_missing_routing(spark):
    docs = documents_from_lines(spark.createDataFrame([('{"k":"1"}',), ("{}",), ("{}",)], "value string"), id_field="k")
    rows = shard_counts(spark, prepare(docs, IndexSpec("x", 2)), 2).collect()
    assert sum(r.submitted for r in rows) == 3 and [r.submitted for r in rows if r.shard is None] == [2]


def test_route_search_goes_on_beyond_its_first_range(spark):
    whole = {r.bucket: r.route for r in route_table(spark, 16).collect()}
    assert {r.bucket: r.route for r in route_table(spark, 16, limit=10).collect()} == whole
    with pytest.raises(ValueError, match="missing buckets"):
        route_table(spark, 33, limit=100, most=1000)
