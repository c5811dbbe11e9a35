"""Arrays of objects checked at every level, damage found with its reason, generations out of use removed."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shardsmith.operators.documents import documents_from_lines
from shardsmith.operators.validate import validate
from shardsmith.plans import layout
from shardsmith.plans.build import (
    AUTO_DELTA_MAX_LAYERS,
    IndexSpec,
    build_index,
    choose_mode,
    delete_path,
    expire_snapshots,
    latest_snapshot,
    list_snapshots,
    path_exists,
    restore_snapshot,
    upsert,
    verify_snapshot,
)
from shardsmith.sources.template import parse_template


def _docs(spark, pairs):
    lines = [(json.dumps({"k": k, "v": v}),) for k, v in pairs]
    return documents_from_lines(spark.createDataFrame(lines, "value string"), id_field="k", seq_field="v")


@pytest.mark.parametrize(
    ("line", "reason"),
    [
        ('{"tags":[{"o":{"x":1}},{"o":{"x":2},"more":[{"y":"a"}]}]}', None),
        ('{"tags":[{"o":null},null,{}]}', None),
        ('{"tags":[{"o":{"x":1,"zzz":2}}]}', "undeclared_field"),
        ('{"tags":[{"more":[{"y":"a","z":1}]}]}', "undeclared_field"),
        ('{"tags":[{"o":{"x":"text"}}]}', "wrong_type"),
        ('{"tags":[{"o":7}]}', "wrong_type"),
        ('{"tags":[{"more":{"y":"a"}}]}', "wrong_type"),
        ('{"tags":[{"more":[{"y":{"deep":1}}]}]}', "wrong_type"),
        ('{"tags":[3]}', "wrong_type"),
    ],
)
def test_objects_inside_arrays(spark, line, reason):
    nested = {"o": {"properties": {"x": {"type": "integer"}}}, "more": {"type": "nested", "properties": {"y": {"type": "string"}}}}
    m = parse_template(json.dumps({"mappings": {"t": {"dynamic": "strict", "properties": {"tags": {"type": "nested", "properties": nested}}}}}))
    (r,) = validate(documents_from_lines(spark.createDataFrame([(line,)], "value string")), m).select("_reason").collect()
    assert r._reason == reason


def test_a_lost_folder_is_a_reason_not_an_error(spark, scratch):
    res = build_index(spark, _docs(spark, [(str(i), 1) for i in range(40)]), scratch, IndexSpec("x", 2))
    delete_path(spark, layout.shard_path(scratch, "x", res.generation, 1))
    rows = {r.shard: r for r in verify_snapshot(spark, scratch, "x").collect()}
    assert rows[0].ok and rows[0].reason is None
    assert not rows[1].ok and rows[1].reason == "missing_folder" and rows[1].docs == 0


def test_expired_generations_go_and_the_index_stays(spark, scratch):
    spec = IndexSpec("x", 2)
    first = build_index(spark, _docs(spark, [(str(i), 1) for i in range(40)]), scratch, spec)
    upsert(spark, _docs(spark, [("1", 2)]), scratch, spec, mode="rewrite")  # the other shard stays in the first generation
    last = upsert(spark, _docs(spark, [("2", 3)]), scratch, spec, mode="delta")
    before = sorted((r._id, r._seq) for r in restore_snapshot(spark, scratch, "x").collect())
    assert expire_snapshots(spark, scratch, "x") == []  # all are younger than a week
    gone = expire_snapshots(spark, scratch, "x", keep=1, older_than=dt.timedelta(0))
    assert gone and [r.generation for r in list_snapshots(spark, scratch, "x").collect()] == [last.generation]
    assert latest_snapshot(spark, scratch, "x")["generation"] == last.generation
    assert sorted((r._id, r._seq) for r in restore_snapshot(spark, scratch, "x").collect()) == before
    assert verify_snapshot(spark, scratch, "x").where(~F.col("ok")).isEmpty()
    with pytest.raises(ValueError, match="keep"):
        expire_snapshots(spark, scratch, "x", keep=0)


def test_auto_folds_layers_when_they_are_many():
    row = {"bytes": 1000, "docs": 100, "delta_docs": 1, "base_docs": 100}
    few = {0: {**row, "delta_gens": "g1"}}
    many = {0: {**row, "delta_gens": ",".join(f"g{i}" for i in range(AUTO_DELTA_MAX_LAYERS))}}
    assert choose_mode(few, {0: 1}) == "delta" and choose_mode(many, {0: 1}) == "rewrite"
