import os

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES, SF001
from shardsmith.functions.hashing import bucket_py
from shardsmith.operators.documents import documents_from_lines, documents_from_table
from shardsmith.operators.search import get_by_id, multi_get
from shardsmith.plans import layout
from shardsmith.plans.alias import add_alias, resolve_alias
from shardsmith.plans.build import (
    IndexSpec,
    build_index,
    read_manifest,
    restore_snapshot,
    upsert,
    verify_snapshot,
)
from shardsmith.sources.template import load_template


def _events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    return documents_from_table(ev, "event_id", routing_col="user_id", seq_col="event_id")


@pytest.fixture(scope="module")
def built(spark):
    from shardsmith.session import shared_dir

    dest = shared_dir(spark, "tests", "built", unique=True)
    res = build_index(spark, _events(spark), dest, IndexSpec("events", 8, type_name="event"))
    return dest, res


def test_invariants(spark, built):
    dest, res = built
    m = res.metrics
    assert m["scanned"] == m["rejects"] + m["docs"]
    man = read_manifest(spark, dest, "events").collect()
    assert sorted(r.shard for r in man) == list(range(8))
    assert sum(r.docs for r in man) == m["docs"] == 1000


def test_restore_equals_input(spark, built):
    dest, _ = built
    restored = restore_snapshot(spark, dest, "events").select("_id", "_source")
    src = _events(spark).select("_id", "_source")
    assert restored.exceptAll(src).count() == 0 and src.exceptAll(restored).count() == 0


def test_every_row_in_its_routed_shard(spark, built):
    dest, _ = built
    assert all(r.ok for r in verify_snapshot(spark, dest, "events").collect())


def test_rebuild_is_stable(spark, built):
    dest, res = built
    from shardsmith.session import shared_dir

    dest2 = shared_dir(spark, "tests", "rebuilt", unique=True)
    res2 = build_index(spark, _events(spark), dest2, IndexSpec("events", 8, type_name="event"))
    a = sorted((r.shard, r.docs, r.bytes, r.checksum) for r in read_manifest(spark, dest, "events").collect())
    b = sorted((r.shard, r.docs, r.bytes, r.checksum) for r in read_manifest(spark, dest2, "events").collect())
    assert a == b


def test_get_by_id_prunes_to_one_shard(spark, built):
    dest, _ = built
    idx = restore_snapshot(spark, dest, "events")
    ev = spark.read.parquet(f"{SF001}/events.parquet").where("event_id = 5").first()
    got = get_by_id(idx, 8, ["5"], routing=[str(ev.user_id)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"(_shard#" in plan
    rows = got.collect()
    assert len(rows) == 1 and rows[0]._shard == bucket_py(str(ev.user_id), 8)


def test_multi_get(spark, built):
    dest, _ = built
    idx = restore_snapshot(spark, dest, "events")
    wanted = spark.read.parquet(f"{SF001}/events.parquet").where("event_type = 'error'").select(
        F.col("event_id").cast("string").alias("_id"), F.col("user_id").cast("string").alias("r")
    )
    assert multi_get(idx, 8, wanted, routing_col="r").count() == wanted.count()


def test_uncommitted_generation_is_invisible(spark, built):
    dest, res = built
    fake = layout.data_path(dest, "events", "gzzzz")  # sorts after every real id, but has no snapshot row
    spark.createDataFrame([("x", 1)], "_id string, _shard int").write.partitionBy("_shard").parquet(fake)
    assert restore_snapshot(spark, dest, "events").count() == 1000


def test_upsert_rewrites_only_touched_shards(spark, scratch):
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    docs = documents_from_table(cust, "c_custkey")
    spec = IndexSpec("customer", 8, type_name="customer")
    base = build_index(spark, docs, scratch, spec)
    change = cust.where("c_custkey = 7").withColumn("c_name", F.lit("changed"))
    new = spark.createDataFrame([(10**6, "new", 1, 1.0, "NEW")], cust.schema)
    res = upsert(spark, documents_from_table(change.unionByName(new), "c_custkey", seq_col=F.lit(1)), scratch, spec,
                 mode="rewrite")
    man = {r.shard: r for r in read_manifest(spark, scratch, "customer").collect()}
    touched = {bucket_py("7", 8), bucket_py(str(10**6), 8)}
    for s, r in man.items():
        assert (r.data_gen == res.generation) == (s in touched)
    out = restore_snapshot(spark, scratch, "customer")
    assert out.count() == cust.count() + 1
    assert out.where("c_custkey = 7").first().c_name == "changed"
    assert all(r.ok for r in verify_snapshot(spark, scratch, "customer").collect())


def test_hot_shard_is_split_not_truncated(spark, scratch):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    # every document routed to one key: one shard holds all rows
    docs = documents_from_table(ev, "event_id", routing_col=F.lit("hot"))
    res = build_index(spark, docs, scratch, IndexSpec("hot", 4, target_file_bytes=20_000))
    man = {r.shard: r for r in read_manifest(spark, scratch, "hot").collect()}
    hot = bucket_py("hot", 4)
    assert man[hot].docs == 1000 and man[hot].files > 1
    assert sum(r.docs for r in man.values()) == 1000


def test_lines_with_rejects(spark, scratch):
    mapping = load_template(spark, os.path.join(FIXTURES, "template.json"))
    lines = ['{"a": 1, "b": "x"}', '{"a": 2, "b": "y"}', '{"a":1,"zzz":2}', "nope", '{"a": 1, "b": "z"}']
    path = f"{scratch}/in"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    docs = documents_from_lines(spark.read.text(path), id_field="a")
    res = build_index(spark, docs, f"{scratch}/out", IndexSpec("mydata", 8, mapping=mapping))
    assert res.metrics["scanned"] == 5 and res.metrics["rejects"] == 2
    reasons = sorted(r.reason for r in res.rejects(spark).collect())
    assert reasons == ["not_an_object", "undeclared_field"]
    # ids 1 (twice) and 2: last write wins per id, ties broken by the source text
    out = sorted((r._id, r.b) for r in restore_snapshot(spark, f"{scratch}/out", "mydata").collect())
    assert out == [("1", "z"), ("2", "y")]


def test_alias_newest_wins(spark, scratch):
    add_alias(spark, scratch, "live", "events_v1", seq=1)
    add_alias(spark, scratch, "live", "events_v2", seq=2)
    assert resolve_alias(spark, scratch, "live") == "events_v2"


def test_empty_input_commits_empty_shards(spark, scratch):
    empty = spark.createDataFrame([], "value string")
    res = build_index(spark, documents_from_lines(empty), scratch, IndexSpec("empty", 3))
    man = read_manifest(spark, scratch, "empty").collect()
    assert sorted((r.shard, r.docs) for r in man) == [(0, 0), (1, 0), (2, 0)]
    assert restore_snapshot(spark, scratch, "empty").count() == 0


def test_hot_id_is_reduced_in_parallel(spark, scratch):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    hot_id = F.when(F.col("event_type") == "click", F.lit("hot")).otherwise(F.col("event_id").cast("string"))
    docs = documents_from_table(ev, hot_id, seq_col="event_id")
    from shardsmith.plans import build as B

    seen = []
    orig = B.hot_ids
    B.hot_ids = lambda *a, **k: seen.append(orig(*a, **k)) or seen[-1]
    try:
        build_index(spark, docs, scratch, IndexSpec("hotid", 4, target_file_bytes=10_000))
    finally:
        B.hot_ids = orig
    assert len(seen) == 1 and len(seen[0]) == 1  # exactly the one hot id
    out = restore_snapshot(spark, scratch, "hotid")
    n_click = ev.where("event_type = 'click'").count()
    assert out.count() == 1000 - n_click + 1
    top = ev.where("event_type = 'click'").agg(F.max("event_id")).first()[0]
    assert out.where("_id = 'hot'").first().event_id == top
    assert all(r.ok for r in verify_snapshot(spark, scratch, "hotid").collect())


def test_copies_without_dedup_are_kept(spark, scratch):
    lines = ['{"a": 1}'] * 300 + ['{"a": 2}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    spec = IndexSpec("copies", 2, dedup=False, target_file_bytes=1_000)
    res = build_index(spark, documents_from_lines(df), scratch, spec)
    man = read_manifest(spark, scratch, "copies").collect()
    assert sum(r.docs for r in man) == 301
    assert max(r.files for r in man) > 1  # the 300 copies are spread over several tasks


def test_compact_after_upserts(spark, scratch):
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = IndexSpec("cc", 4, type_name="customer", target_file_bytes=4_000)
    build_index(spark, documents_from_table(cust, "c_custkey"), scratch, spec)
    many = read_manifest(spark, scratch, "cc").collect()
    assert max(r.files for r in many) > 1
    from shardsmith.plans.build import compact_index

    spec_big = IndexSpec("cc", 4, type_name="customer")
    res = compact_index(spark, scratch, spec_big)
    man = read_manifest(spark, scratch, "cc").collect()
    assert all(r.files == 1 for r in man) and sum(r.docs for r in man) == cust.count()
    assert all(r.file_bytes > 0 for r in man)
    assert all(r.ok for r in verify_snapshot(spark, scratch, "cc").collect())


def test_source_label_from_file_names(spark, scratch):
    from shardsmith.sources.lines import read_lines, with_source_label

    for name in ["ALL CATEGORIES0.txt.gz", "BOOKS7.txt.gz"]:
        path = f"{scratch}/src/{name}"
        import gzip

        local = path[len("file:"):] if path.startswith("file:") else path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with gzip.open(local, "wt") as fh:
            fh.write('{"a": 1}\n{"a": 2}\n')
    df = with_source_label(read_lines(spark, f"{scratch}/src", spread=False))
    got = sorted({r.source for r in df.collect()})
    assert got == ["ALL CATEGORIES", "BOOKS"] and df.count() == 4
    from shardsmith.sources import tables

    old = tables.SPREAD_MIN_BYTES
    try:  # force the spread path: the label must be taken before it
        tables.SPREAD_MIN_BYTES = 0
        spread = read_lines(spark, f"{scratch}/src", label="source")
        assert sorted({r.source for r in spread.collect()}) == ["ALL CATEGORIES", "BOOKS"]
    finally:
        tables.SPREAD_MIN_BYTES = old


def test_build_survives_task_retries():
    import json
    import subprocess
    import sys

    import tempfile

    here = os.path.dirname(os.path.abspath(__file__))
    marker = os.path.join(tempfile.mkdtemp(prefix="retry-"), "failed-once")
    out = subprocess.run(
        [sys.executable, os.path.join(here, "scripts", "retry_build.py"), os.path.dirname(here), SF001, marker],
        capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert os.path.exists(marker)  # a task attempt really failed and was retried
    res = json.loads(out.stdout.strip().splitlines()[-1])
    assert res["clean"] == res["faulty"] and sum(r[1] for r in res["clean"]) == 1000


def test_delta_upserts_layer_verify_and_compact(spark, scratch):
    from shardsmith.plans.build import compact_index

    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = IndexSpec("cd", 8, type_name="customer")
    base = build_index(spark, documents_from_table(cust, "c_custkey"), scratch, spec)
    change = cust.where("c_custkey = 7").withColumn("c_name", F.lit("changed"))
    new = spark.createDataFrame([(10**6, "new", 1, 1.0, "NEW")], cust.schema)
    d1 = upsert(spark, documents_from_table(change.unionByName(new), "c_custkey", seq_col=F.lit(1)), scratch, spec, mode="delta")
    man = {r.shard: r for r in read_manifest(spark, scratch, "cd").collect()}
    touched = {bucket_py("7", 8), bucket_py(str(10**6), 8)}
    for s, r in man.items():
        assert r.data_gen == base.generation  # no shard rewritten
        assert (r.delta_gens == d1.generation) == (s in touched)
    out = restore_snapshot(spark, scratch, "cd")
    assert out.count() == cust.count() + 1 and out.where("c_custkey = 7").first().c_name == "changed"
    assert all(r.ok for r in verify_snapshot(spark, scratch, "cd").collect())
    # a lower version loses, an equal version (a later write) wins
    older = cust.where("c_custkey = 7").withColumn("c_name", F.lit("older"))
    upsert(spark, documents_from_table(older, "c_custkey", seq_col=F.lit(0)), scratch, spec, mode="delta")
    assert restore_snapshot(spark, scratch, "cd").where("c_custkey = 7").first().c_name == "changed"
    same = cust.where("c_custkey = 7").withColumn("c_name", F.lit("again"))
    upsert(spark, documents_from_table(same, "c_custkey", seq_col=F.lit(1)), scratch, spec, mode="delta")
    out = restore_snapshot(spark, scratch, "cd")
    assert out.count() == cust.count() + 1 and out.where("c_custkey = 7").first().c_name == "again"
    assert all(r.ok for r in verify_snapshot(spark, scratch, "cd").collect())
    assert get_by_id(out, 8, ["7"]).first().c_name == "again"
    before = sorted((r._id, r._source) for r in out.collect())
    compact_index(spark, scratch, spec)
    man = read_manifest(spark, scratch, "cd").collect()
    assert all(not r.delta_gens for r in man)
    after = sorted((r._id, r._source) for r in restore_snapshot(spark, scratch, "cd").collect())
    assert before == after
    assert all(r.ok for r in verify_snapshot(spark, scratch, "cd").collect())


def test_rewrite_after_delta_keeps_everything(spark, scratch):
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = IndexSpec("cr", 4, type_name="customer")
    build_index(spark, documents_from_table(cust, "c_custkey"), scratch, spec)
    a = cust.where("c_custkey < 20").withColumn("c_name", F.lit("delta"))
    upsert(spark, documents_from_table(a, "c_custkey", seq_col=F.lit(1)), scratch, spec, mode="delta")
    b = cust.where("c_custkey = 3").withColumn("c_name", F.lit("rewrite"))
    upsert(spark, documents_from_table(b, "c_custkey", seq_col=F.lit(2)), scratch, spec)
    out = restore_snapshot(spark, scratch, "cr")
    assert out.count() == cust.count()
    names = {r.c_custkey: r.c_name for r in out.where("c_custkey < 20").collect()}
    assert names[3] == "rewrite" and all(v == "delta" for k, v in names.items() if k != 3)
    assert all(r.ok for r in verify_snapshot(spark, scratch, "cr").collect())


def test_auto_mode_picks_by_size(spark, scratch):
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = IndexSpec("ca", 2, type_name="customer")
    base = build_index(spark, documents_from_table(cust, "c_custkey"), scratch, spec)
    one = cust.where("c_custkey = 5").withColumn("c_name", F.lit("one"))
    r1 = upsert(spark, documents_from_table(one, "c_custkey", seq_col=F.lit(1)), scratch, spec)
    man = read_manifest(spark, scratch, "ca").collect()
    assert all(r.data_gen == base.generation for r in man)  # small change: a delta layer
    assert any(r.delta_gens == r1.generation for r in man)
    many = cust.withColumn("c_name", F.lit("all"))
    r2 = upsert(spark, documents_from_table(many, "c_custkey", seq_col=F.lit(2)), scratch, spec)
    man = read_manifest(spark, scratch, "ca").collect()
    assert all(r.data_gen == r2.generation and not r.delta_gens for r in man)  # large: rewrite, layers folded
    out = restore_snapshot(spark, scratch, "ca")
    assert out.count() == cust.count() and {r.c_name for r in out.collect()} == {"all"}
    assert all(r.ok for r in verify_snapshot(spark, scratch, "ca").collect())


def test_concurrent_update_is_refused(spark, scratch):
    from shardsmith.plans import build as B

    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = IndexSpec("cu", 2, type_name="customer")
    build_index(spark, documents_from_table(cust, "c_custkey"), scratch, spec)
    one = documents_from_table(cust.where("c_custkey = 5"), "c_custkey", seq_col=F.lit(1))
    orig = B.ingest

    def racing_ingest(*a, **k):  # another writer commits while this upsert is running
        B.ingest = orig
        upsert(spark, documents_from_table(cust.where("c_custkey = 6"), "c_custkey", seq_col=F.lit(1)), scratch, spec)
        return orig(*a, **k)

    B.ingest = racing_ingest
    try:
        with pytest.raises(B.ConcurrentUpdateError):
            upsert(spark, one, scratch, spec)
    finally:
        B.ingest = orig
    assert restore_snapshot(spark, scratch, "cu").count() == cust.count()


def test_quick_verify_reads_small_columns(spark, built):
    dest, _ = built
    quick = verify_snapshot(spark, dest, "events", deep=False)
    assert all(r.ok for r in quick.collect())
    plan = quick._jdf.queryExecution().executedPlan().toString()
    import re

    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("_source" not in s for s in schemas)


def test_table_documents_checked_against_a_mapping(spark, scratch):
    from shardsmith.sources.template import parse_template

    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    m = parse_template('{"mappings": {"c": {"dynamic": "strict", "properties": {'
                       '"c_custkey": {"type": "long"}, "c_name": {"type": "keyword"}, "c_nationkey": {"type": "integer"},'
                       '"c_acctbal": {"type": "double"}, "c_mktsegment": {"type": "keyword"}}}}}')
    res = build_index(spark, documents_from_table(cust, "c_custkey"), scratch, IndexSpec("cm", 4, mapping=m))
    assert res.metrics["rejects"] == 0 and res.metrics["docs"] == cust.count()
    out = restore_snapshot(spark, scratch, "cm")
    assert out.columns.count("c_name") == 1
    assert out.select("c_custkey", "c_name").exceptAll(cust.select("c_custkey", "c_name")).count() == 0


def test_lookup_through_alias(spark, scratch):
    from shardsmith.plans.read import lookup, open_index

    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    build_index(spark, documents_from_table(cust, "c_custkey"), scratch, IndexSpec("cust_v1", 5, type_name="customer"))
    add_alias(spark, scratch, "customers", "cust_v1")
    docs, n = open_index(spark, scratch, "customers")
    assert n == 5 and docs.count() == cust.count()
    got = lookup(spark, scratch, "customers", ["42", "7"]).select("c_custkey").collect()
    assert sorted(r.c_custkey for r in got) == [7, 42]
    assert lookup(spark, scratch, "cust_v1", ["42"]).count() == 1
