"""Scratch tables go when the caller says that their results are done with."""

import pytest

from conftest import SF001
from shardsmith.operators.dedup import assign_bulks
from shardsmith.operators.documents import documents_from_table
from shardsmith.operators.routing import assign_shards
from shardsmith.plans.commits import exists
from shardsmith.session import scratch_scope, shared_dir


def test_scratch_goes_with_its_scope(spark):
    before = shared_dir(spark, "tests", unique=True)
    spark.range(3).write.parquet(before)
    docs = documents_from_table(spark.read.parquet(f"{SF001}/orders.parquet"), "o_orderkey")
    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as made:
            out = assign_bulks(assign_shards(docs, 4), 100, order=("_id",))
            assert out.count() == docs.count() and made and all(exists(spark, p) for p in made)
        assert not any(exists(spark, p) for p in made) and set(made) <= set(outer)
        kept = shared_dir(spark, "tests", unique=True)
        spark.range(2).write.parquet(kept)
    assert not exists(spark, kept) and exists(spark, before)


def test_scratch_goes_after_a_failure(spark):
    with pytest.raises(ValueError, match="stop"):
        with scratch_scope(spark) as made:
            spark.range(2).write.parquet(shared_dir(spark, "tests", unique=True))
            raise ValueError("stop")
    assert made and not exists(spark, made[0])
