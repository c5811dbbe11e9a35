"""File tables, key slices, masks, the build's proof, and compaction by plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from shardsmith.operators.documents import documents_from_table
from shardsmith.operators.search import get_by_id, multi_get
from shardsmith.plans import build as B
from shardsmith.plans import files, layout
from shardsmith.plans.build import IndexSpec, build_index, compact_index, plan_compaction, read_manifest, restore_snapshot, upsert, verify_files, verify_snapshot

DOCS = "_id string, _routing string, _seq bigint, _source string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(str(i), str(i), q, '{"v":"%s"}' % v) for i, q, v in rows], DOCS).repartition(parts)


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_slice_ranges():
    rng = random.Random(1)
    for _ in range(300):
        slices = [rng.randrange(files.SLICES) for _ in range(rng.randrange(0, 60))] + list(range(5, rng.randrange(5, 20)))
        most = rng.randrange(1, 30)
        got = files.slice_ranges(slices, most)
        assert len(got) <= most and all(any(a <= s <= b for a, b in got) for s in slices)
        if most >= len(set(slices)):  # nothing but the slices, when there is room
            assert sum(b - a + 1 for a, b in got) == len(set(slices))


@pytest.mark.parametrize("seed,mask_bytes", [(1, None), (2, 1)])
def test_updates_against_a_model(spark, scratch, monkeypatch, seed, mask_bytes):
    """Any order of deltas, rewrites and compactions reads like a dictionary, and verifies."""
    if mask_bytes:
        monkeypatch.setattr(files, "BROADCAST_MASK_BYTES", mask_bytes)  # shards read in groups of their own
    rng = random.Random(seed)
    spec = IndexSpec("m", 2, target_file_bytes=2500)
    first = [(i, 1, "base") for i in range(300)]
    build_index(spark, docs(spark, first), scratch, spec)
    model = {str(i): (q, v) for i, q, v in first}
    for step, mode in enumerate(("delta", "delta", "compact", "delta", "rewrite", "delta")[seed - 1 :]):
        if mode == "compact":
            compact_index(spark, scratch, spec)
        else:
            change = [(rng.randrange(340), rng.randrange(4), f"s{step}") for _ in range(rng.choice((1, 30, 90)))]
            change = list({i: (i, q, v) for i, q, v in change}.values())
            upsert(spark, docs(spark, change), scratch, spec, mode=mode)
            for i, q, v in change:
                if q >= model.get(str(i), (-1,))[0]:
                    model[str(i)] = (q, v)
        got = restore_snapshot(spark, scratch, "m").select("_id", "_seq", F.get_json_object("_source", "$.v").alias("v")).collect()
        assert sorted((r._id, r._seq, r.v) for r in got) == sorted((i, q, v) for i, (q, v) in model.items())
    assert verify_snapshot(spark, scratch, "m").where("NOT ok").collect() == []
    man = read_manifest(spark, scratch, "m").collect()
    assert sum(r.docs for r in man) == len(model) and any(r.mask_bytes for r in man)


def test_reads_over_layers_are_scans(spark, scratch):
    """No shuffle, sort or window over layers of any number; filters still reach the files."""
    cust = spark.read.parquet(f"{SF001}/customer.parquet")
    spec = IndexSpec("c", 4)
    build_index(spark, documents_from_table(cust, "c_custkey"), scratch, spec)
    for i in range(3):
        change = cust.where(f"c_custkey % 3 = {i}").withColumn("c_name", F.lit(f"n{i}"))
        upsert(spark, documents_from_table(change, "c_custkey", seq_col=F.lit(i + 1)), scratch, spec, mode="delta")
    index = restore_snapshot(spark, scratch, "c")
    p = plan(index)
    assert "BroadcastHashJoin" in p and not re.search(r"\bExchange\b|Window|Sort", p.replace("BroadcastExchange", ""))
    assert {r.c_name for r in index.collect()} == {"n0", "n1", "n2"} and index.count() == cust.count()
    p = plan(get_by_id(index, 4, ["42"]))
    assert re.search(r"PartitionFilters: \[.*_shard", p) and "EqualTo(_id,42)" in p
    assert [r.c_name for r in get_by_id(index, 4, ["42"]).collect()] == ["n0"]
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(index.select("c_name"))).group(1)
    assert [c.split(":")[0] for c in read.split(",")] == ["c_name", "_tmp_metadata_row_index"]


def scanned_rows(df) -> int:
    """Rows that the scans of an executed plan gave."""
    df.collect()
    p = df._jdf.queryExecution().executedPlan()
    p = p.executedPlan() if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else p
    leaves = [p.collectLeaves().apply(i) for i in range(p.collectLeaves().size())]
    return sum(x.metrics().apply("numOutputRows").value() for x in leaves if x.getClass().getSimpleName() == "FileSourceScanExec")


def test_lookup_reads_only_files_of_the_slices(spark, scratch, monkeypatch):
    spec = IndexSpec("s", 2, target_file_bytes=1000)
    build_index(spark, docs(spark, [(i, 1, "base") for i in range(2000)]), scratch, spec)
    table = files.read_file_table(spark, scratch, "s", [restore_gen(spark, scratch, "s")]).collect()
    assert len(table) > 20 and all(r.slice_hi - r.slice_lo < files.SLICES / 5 for r in table)
    seen = []
    stored = B._stored_rows
    monkeypatch.setattr(B, "_stored_rows", lambda *a: seen.append(stored(*a)) or seen[-1])
    upsert(spark, docs(spark, [(7, 2, "new")]), scratch, spec, mode="delta")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(_slice,\d+\)", plan(seen[0]))
    scan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "_source" not in scan.split("Relation")[0]
    touched = [r for r in table if r.slice_lo <= slice_of(spark, "7") <= r.slice_hi]
    index = restore_snapshot(spark, scratch, "s")
    assert scanned_rows(index.where(files.in_slices([slice_of(spark, "7")])).select("_id")) <= sum(r.docs for r in touched) + 1
    assert index.where("_id = '7'").first()._seq == 2 and index.count() == 2000


def restore_gen(spark, dest, index):
    return B.latest_snapshot(spark, dest, index)["generation"]


def slice_of(spark, key):
    return spark.range(1).select(files.key_slice(F.lit(key)).alias("s")).first().s


def test_file_table_without_sorting_rows(spark, scratch):
    res = build_index(spark, docs(spark, [(i, 1, "x" * (i % 50)) for i in range(1500)]), scratch, IndexSpec("f", 3, target_file_bytes=4000))
    written = spark.read.parquet(layout.data_path(scratch, "f", res.generation))
    stats = files.file_stats(written)
    ids = files.file_ids(written, stats)
    assert "SortAggregate" not in plan(stats) + plan(ids) and "HashAggregate" in plan(stats)
    want = written.groupBy(F.col("_metadata.file_name").alias("file"), F.col("_shard").cast("int").alias("shard")).agg(
        F.count("*").alias("docs"), F.min("_id").alias("min_id"), F.max("_id").alias("max_id"), F.sum("_bytes").alias("bytes"), F.min("_slice").alias("lo"), F.max("_slice").alias("hi"))
    got = files.read_file_table(spark, scratch, "f", [res.generation])
    assert sorted((r.file, r.shard, r.docs, r.min_id, r.max_id, r.bytes, r.slice_lo, r.slice_hi) for r in got.collect()) == sorted(
        (r.file, r.shard, r.docs, r.min_id, r.max_id, r.bytes, r.lo, r.hi) for r in want.collect())
    man = {r.shard: r for r in res.manifest(spark).collect()}
    assert sum(r.files for r in man.values()) == got.count() > 3


def test_a_build_proves_that_no_accepted_row_is_lost(spark, scratch, monkeypatch):
    rows = [(i % 50, i, "v") for i in range(200)]
    res = build_index(spark, docs(spark, rows), scratch, IndexSpec("p", 2))
    assert res.metrics["docs"] == 50 and res.metrics["copies"] == 200
    dedup = B._dedup
    monkeypatch.setattr(B, "_dedup", lambda df, keys: dedup(df, keys).where("_id <> '7'"))  # a fault that files and job agree on
    with pytest.raises(RuntimeError, match="200 rows went in"):
        build_index(spark, docs(spark, rows), scratch, IndexSpec("p", 2))
    with pytest.raises(RuntimeError, match="accepted"):
        upsert(spark, docs(spark, [(7, 500, "w"), (8, 500, "w")]), scratch, IndexSpec("p", 2), mode="delta")
    monkeypatch.undo()
    assert restore_snapshot(spark, scratch, "p").count() == 50 and B.latest_snapshot(spark, scratch, "p")["commit_no"] == 1


def test_hot_ids_are_counted_through_both_steps(spark, scratch):
    rows = [("hot", i, "v" * 40) for i in range(600)] + [(i, 1, "v" * 40) for i in range(300)]
    res = build_index(spark, docs(spark, rows), scratch, IndexSpec("h", 2, target_file_bytes=3000))
    assert res.metrics["docs"] == 301 and res.metrics["copies"] == 900
    assert restore_snapshot(spark, scratch, "h").where("_id = 'hot'").first()._seq == 599


def test_plan_text_does_not_grow_with_hot_ids(spark):
    staged = docs(spark, [(i, 1, "x") for i in range(10)]).withColumns({"_shard": F.lit(0), "_bytes": F.lit(1).cast("bigint"), "_hash": F.lit(1).cast("bigint")})
    size = [len(plan(B.shard_layout(staged, IndexSpec("x", 1, target_file_bytes=1), {0: 4}, list(range(n))))) for n in (2, 5000)]
    assert size[1] < 1.2 * size[0]


def test_verify_names_the_file(spark, scratch):
    spec = IndexSpec("v", 2, target_file_bytes=4000)
    first = build_index(spark, docs(spark, [(i, 1, "base") for i in range(900)]), scratch, spec)
    second = upsert(spark, docs(spark, [(i, 2, "new") for i in range(20)]), scratch, spec, mode="delta")
    each = verify_files(spark, scratch, "v").collect()
    assert all(r.ok for r in each) and {r.gen for r in each} == {first.generation, second.generation}
    newer = verify_files(spark, scratch, "v", since=first.generation)
    assert {r.gen for r in newer.collect()} == {second.generation} and newer.where("NOT ok").isEmpty()
    table = files.read_file_table(spark, scratch, "v", [first.generation]).orderBy("shard", "file").collect()
    folder = lambda r: layout.shard_path(scratch, "v", first.generation, r.shard)
    gone, cut = table[0], table[-1]
    fs, p = B.commits._fs(spark, f"{folder(gone)}/{gone.file}")[::-1]
    fs.delete(p, False)
    same = spark.read.parquet(f"{folder(cut)}/{cut.file}").limit(cut.docs - 1).coalesce(1)
    same.write.parquet(f"{scratch}/cut")
    part = [x for x in spark.read.parquet(f"{scratch}/cut").inputFiles()][0]
    q = B.commits._fs(spark, f"{folder(cut)}/{cut.file}")[1]
    src = B.commits._fs(spark, part)[0]
    q.delete(B.commits._fs(spark, f"{folder(cut)}/{cut.file}")[0], False)
    q.rename(src, B.commits._fs(spark, f"{folder(cut)}/{cut.file}")[0])
    bad = {r.file: r.reason for r in verify_files(spark, scratch, "v").where("NOT ok").collect()}
    assert bad == {gone.file: "missing_file", cut.file: "docs"}
    by_shard = {r.shard: r for r in verify_snapshot(spark, scratch, "v").collect()}
    assert by_shard[gone.shard].file == gone.file and by_shard[gone.shard].file_reason == "missing_file"
    assert by_shard[cut.shard].file in (cut.file, gone.file) and not by_shard[cut.shard].ok
    assert verify_files(spark, scratch, "v", since=first.generation).where("NOT ok").isEmpty()


def test_compaction_writes_what_the_plan_picks(spark, scratch):
    spec = IndexSpec("k", 4)
    build_index(spark, docs(spark, [(i, 1, "base") for i in range(400)]), scratch, spec)
    assert compact_index(spark, scratch, spec).metrics["picked"] == [] and B.latest_snapshot(spark, scratch, "k")["commit_no"] == 1
    upsert(spark, docs(spark, [(5, 2, "new")]), scratch, spec, mode="delta")
    man = {r.shard: r.asDict() for r in read_manifest(spark, scratch, "k").collect()}
    layered = [s for s, r in man.items() if r["delta_gens"]]
    assert plan_compaction(list(man.values()), spec.target_file_bytes) == layered and len(layered) == 1
    res = compact_index(spark, scratch, spec)
    assert res.metrics["picked"] == layered and res.metrics["bytes"] == man[layered[0]]["bytes"]
    written = spark.read.parquet(layout.data_path(scratch, "k", res.generation))
    assert {r._shard for r in written.select("_shard").distinct().collect()} == set(layered)
    after = {r.shard: r for r in read_manifest(spark, scratch, "k").collect()}
    assert not any(r.delta_gens or r.mask_bytes for r in after.values()) and sum(r.docs for r in after.values()) == 400
    assert verify_snapshot(spark, scratch, "k").where("NOT ok").isEmpty()
    small = [{"shard": 0, "docs": 10, "bytes": 1000, "files": 9, "base_docs": 10, "delta_gens": "", "delta_docs": 0}]
    assert plan_compaction(small, 500) == [0] and plan_compaction(small, 100) == []
    with pytest.raises(ValueError, match="no such shards"):
        compact_index(spark, scratch, spec, shards=[9])


def test_bloom_filters_skip_row_groups(spark, scratch):
    """An id that no row has is answered without reading rows, though it lies between ids that are there."""
    spec = IndexSpec("b", 1)
    build_index(spark, docs(spark, [(f"k{i:05d}", 1, "x") for i in range(0, 4000, 2)]), scratch, spec)
    index = restore_snapshot(spark, scratch, "b").select("_id", "_shard")
    absent = [f"k{i:05d}" for i in range(1001, 1041, 2)]
    assert sum(scanned_rows(get_by_id(index, 1, [a])) > 0 for a in absent) <= 2  # but for a false positive or two
    assert scanned_rows(get_by_id(index, 1, ["k01002"])) > 0 and get_by_id(index, 1, ["k01002"]).count() == 1
    wanted = spark.createDataFrame([(a,) for a in absent], "_id string")
    assert scanned_rows(multi_get(index, 1, wanted)) <= 2000 and multi_get(index, 1, wanted).count() == 0
    many = spark.createDataFrame([(f"k{i:05d}",) for i in range(1000)], "_id string")
    assert multi_get(index, 1, many).count() == 500
