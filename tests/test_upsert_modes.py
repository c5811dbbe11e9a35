"""Upserts mean the same in every mode, and the order of commits is that of their ends."""

import pytest
from pyspark.sql import functions as F

import shardsmith.plans.build as B
from shardsmith.operators.documents import documents_from_lines, documents_from_table
from shardsmith.plans.build import IndexSpec, build_index, latest_snapshot, read_manifest, restore_snapshot, upsert, verify_snapshot

MODES = ("rewrite", "delta", "auto")


def _state(spark, dest, index, cols):
    rows = sorted(tuple(r) for r in restore_snapshot(spark, dest, index).select(*cols).collect())
    man = sorted(tuple(r) for r in read_manifest(spark, dest, index).select("shard", "docs", "bytes", "checksum").collect())
    assert all(r.ok for r in verify_snapshot(spark, dest, index).collect())
    assert latest_snapshot(spark, dest, index)["docs"] == len(rows)
    return rows, man


def test_copies_without_ids_are_added_in_every_mode(spark, scratch):
    lines = spark.range(1000).select(F.to_json(F.struct((F.col("id") % 400).alias("a"))).alias("value"))
    more = documents_from_lines(spark.createDataFrame([('{"a":1}',), ('{"a":1}',), ('{"a":9999}',), ('{"a":9999}',)], "value string"))
    spec = IndexSpec("copies", 2, dedup=False)
    states = []
    for mode in MODES:
        dest = f"{scratch}/{mode}"
        build_index(spark, documents_from_lines(lines), dest, spec)
        upsert(spark, more, dest, spec, mode=mode)
        states.append(_state(spark, dest, "copies", ["_id", "_source"]))
        assert len(states[-1][0]) == 1004
    assert states[0] == states[1] == states[2]
    with pytest.raises(ValueError, match="dedup"):
        upsert(spark, more, dest, IndexSpec("copies", 2))


def test_missing_versions_and_columns_in_every_mode(spark, scratch):
    base = spark.createDataFrame([(1, "a", 10, None), (2, "b", 20, 5), (3, "c", 30, None)], "id int, name string, score int, v long")
    changes = spark.createDataFrame([(1, "A", True, None), (2, "B", True, None), (3, "C", False, 1), (4, "D", False, None)], "id int, name string, flag boolean, v long")
    states = []
    for mode in MODES:
        dest = f"{scratch}/{mode}"
        spec = IndexSpec("t", 2)
        build_index(spark, documents_from_table(base.drop("v"), "id", seq_col=F.when(F.col("id") == 2, 5)), dest, spec)
        upsert(spark, documents_from_table(changes.drop("v"), "id", seq_col=F.when(F.col("id") == 3, 1)), dest, spec, mode=mode)
        states.append(_state(spark, dest, "t", ["id", "name", "score", "flag"]))
    want = [(1, "A", None, True), (2, "b", 20, None), (3, "C", None, False), (4, "D", None, False)]
    assert states[0][0] == want
    assert states[0] == states[1] == states[2]
    wrong = documents_from_table(spark.createDataFrame([(1, 5)], "id int, name int"), "id")
    with pytest.raises(ValueError, match="column 'name'"):
        upsert(spark, wrong, dest, spec)


def test_a_rebuild_that_ends_last_is_visible(spark, scratch):
    docs = lambda *names: documents_from_table(spark.createDataFrame([(n,) for n in names], "name string"), "name")
    spec = IndexSpec("r", 2)
    build_index(spark, docs("1"), scratch, spec)
    ingest = B.ingest

    def held_back(*a, **k):
        B.ingest = ingest
        upsert(spark, docs("2"), scratch, spec)
        return ingest(*a, **k)

    B.ingest = held_back
    try:
        build_index(spark, docs("x", "y", "z"), scratch, spec)
    finally:
        B.ingest = ingest
    assert sorted(r._id for r in restore_snapshot(spark, scratch, "r").collect()) == ["x", "y", "z"]
    assert latest_snapshot(spark, scratch, "r")["commit_no"] == 3
