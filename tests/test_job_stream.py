import os

from conftest import FIXTURES
from shardsmith.plans.build import IndexSpec, build_index, list_snapshots, restore_snapshot
from shardsmith.plans.job import parse_args, run
from shardsmith.operators.documents import documents_from_lines
from shardsmith.sources.template import load_template
from shardsmith.streaming.upserts import start_upsert_stream


def test_cli_job(spark, scratch):
    src = f"{scratch}/input"
    lines = ['{"a": %d, "b": "v%d"}' % (i, i) for i in range(50)] + ['{"a":1,"zzz":2}', "junk"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.text(src)
    args = parse_args([src, f"{scratch}/out", "4", os.path.join(FIXTURES, "template.json"), "idx", "reading", "--id-field", "a"])
    out = run(spark, args)
    assert (out["scanned"], out["docs"], out["rejects"]) == (52, 50, 2)
    got = restore_snapshot(spark, f"{scratch}/out", "idx")
    assert got.count() == 50 and got.select("a", "b").where("a = 7").first().b == "v7"
    # the same job with --upsert applies new lines to the committed index
    src2 = f"{scratch}/input2"
    spark.createDataFrame([('{"a": 7, "b": "new"}',), ('{"a": 99, "b": "added"}',)], "value string").coalesce(1).write.text(src2)
    args2 = parse_args([src2, f"{scratch}/out", "4", os.path.join(FIXTURES, "template.json"), "idx", "reading", "--id-field", "a", "--upsert"])
    run(spark, args2)
    got = restore_snapshot(spark, f"{scratch}/out", "idx")
    assert got.count() == 51 and got.where("a = 7").first().b == "new"


def test_cli_job_plain_text(spark, scratch):
    src = f"{scratch}/text"
    lines = ["first line", "second line", "first line"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(src)
    args = parse_args([src, f"{scratch}/out", "2", os.path.join(FIXTURES, "template.json"), "txt", "reading", "--format", "text"])
    out = run(spark, args)
    assert (out["scanned"], out["docs"], out["rejects"]) == (3, 3, 0)  # equal lines stay separate documents
    got = sorted(r._source for r in restore_snapshot(spark, f"{scratch}/out", "txt").collect())
    assert got == ['{"value":"first line"}', '{"value":"first line"}', '{"value":"second line"}']


def test_stream_upserts(spark, scratch):
    mapping = load_template(spark, os.path.join(FIXTURES, "template.json"))
    spec = IndexSpec("s", 4, mapping=mapping)
    seed = spark.createDataFrame([('{"a": 1, "b": "old"}',)], "value string")
    build_index(spark, documents_from_lines(seed, id_field="a"), f"{scratch}/idx", spec)
    inbox = f"{scratch}/inbox"
    spark.createDataFrame([('{"a": 1, "b": "new"}',), ('{"a": 2, "b": "two"}',)], "value string").coalesce(1).write.text(f"{inbox}/b1")
    q = start_upsert_stream(spark, f"{inbox}/*", f"{scratch}/idx", spec, id_field="a", checkpoint=f"{scratch}/ckpt",
                            trigger={"availableNow": True})
    q.awaitTermination(120)
    got = sorted((r.a, r.b) for r in restore_snapshot(spark, f"{scratch}/idx", "s").collect())
    assert got == [(1, "new"), (2, "two")]
    assert list_snapshots(spark, f"{scratch}/idx", "s").count() == 2
