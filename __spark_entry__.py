"""

Every query reads the given tables (whole tables, whole texts) and runs the
library's operators on them.  The oracle SQL is plain DuckDB over the same
parquet files; where a value depends on the routing hash, the oracle computes
the same DJB2 hash with list functions (see ``_duck_djb2``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.functions.hashing import bucket_py, djb2_hash, hash_bucket
from shardsmith.functions.jsonfn import compact_json, is_json_object
from shardsmith.operators.dedup import assign_bulks, bulk_summary, latest_by_id
from shardsmith.operators.documents import (
    documents_from_columns,
    documents_from_lines,
    documents_from_table,
    envelope,
    text_document,
)
from shardsmith.operators.report import largest_shard, reject_summary, shard_bytes, shard_counts, term_stats
from shardsmith.operators.routing import (
    assign_shards,
    route_lookup,
    route_table,
    shard_grid,
    shard_partition,
    shard_skew,
)
from shardsmith.operators.search import multi_get, range_, search, term
from shardsmith.operators.validate import rejects, typed_projection, validate
from shardsmith.plans import layout
from shardsmith.plans.alias import add_alias, resolve_aliases
from shardsmith.plans.build import (
    ConcurrentUpdateError,
    IndexSpec,
    build_index,
    compact_index,
    delete_path,
    ingest,
    latest_snapshot,
    prepare,
    read_manifest,
    restore_snapshot,
    upsert,
    verify_files,
    verify_snapshot,
)
from shardsmith.plans.commits import put_if_absent
from shardsmith.plans.read import lookup, open_index
from shardsmith.session import shared_dir
from shardsmith.streaming.upserts import start_upsert_stream
from shardsmith.sources.lines import read_lines, source_label
from shardsmith.sources.tables import input_bytes, read_table
from shardsmith.sources.template import load_template, parse_template

# The corpus operators are a part of their own; without it the rest stands.
try:
    import corpus_pipeline
    from shardsmith.llm import queries as corpus_queries
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "shardsmith.llm", "shardsmith.llm.queries"):
        raise
    CORPUS_QUERIES, CORPUS_SQL = {}, {}
else:
    CORPUS_QUERIES = {**corpus_queries.QUERIES, "pipeline": corpus_pipeline.run}
    CORPUS_SQL = dict(corpus_queries.ORACLES)

N = 8  # shard count used by the checks unless a query says otherwise

# A strict mapping of an event's number and kind.
SAMPLE_TEMPLATE = """
{"settings": {"number_of_shards": 8},
 "mappings": {"sample": {"dynamic": "strict", "properties": {"a": {"type": "integer"}, "b": {"type": "keyword"}}}}}
"""
SAMPLE_MAPPING = parse_template(SAMPLE_TEMPLATE)

# Edge lines mixed into the object filter (none of them is an object).
EDGE_LINES = ["[1,2]", "", "nope", "42", "null", '"text"', "[]", "true"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf.rstrip('/')}/{name}.parquet")


def _scratch(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, "queries", name, unique=True)


# ------------------------------------------------------------- documents ----

def _strict_docs(spark: SparkSession, sf: str) -> DataFrame:
    """``{a: event_id, b: event_type}`` per event, id = event_id, routing = user_id."""
    ev = _t(spark, sf, "events")
    body = F.to_json(F.struct(F.col("event_id").alias("a"), F.col("event_type").alias("b")))
    return documents_from_columns(ev, id_col="event_id", routing_col="user_id", seq_col="event_id", source=body)


def _faulty_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Strict docs with faults decided by the event type:
    error -> extra member, click -> fractional ``a``, purchase -> a JSON array,
    view -> ``a`` as numeric text (accepted), signup -> clean."""
    ev = _t(spark, sf, "events")
    et = F.col("event_type")
    body = (
        F.when(et == "error", F.to_json(F.struct(F.col("event_id").alias("a"), et.alias("b"), F.col("value"))))
        .when(et == "click", F.to_json(F.struct(F.col("value").alias("a"), et.alias("b"))))
        .when(et == "purchase", F.to_json(F.array(F.col("event_id").cast("string"), et)))
        .when(et == "view", F.to_json(F.struct(F.col("event_id").cast("string").alias("a"), et.alias("b"))))
        .otherwise(F.to_json(F.struct(F.col("event_id").alias("a"), et.alias("b"))))
    )
    return documents_from_columns(ev, id_col="event_id", routing_col="user_id", seq_col="event_id", source=body)


def _event_docs(spark: SparkSession, sf: str) -> DataFrame:
    ev = _t(spark, sf, "events")
    return documents_from_table(ev, "event_id", routing_col="user_id", seq_col="event_id")


def _publish_table(spark: SparkSession, sf: str, table: str, id_col, name: str, routing_col=None):
    df = _t(spark, sf, table)
    docs = documents_from_table(df, id_col, routing_col=routing_col)
    dest = _scratch(spark, name)
    res = build_index(spark, docs, dest, IndexSpec(table, N, type_name=table))
    return dest, res


# ---------------------------------------------------------------- queries ----

def q_scan_lines(spark, sf):
    path = _scratch(spark, "scan_lines")
    _t(spark, sf, "events").select("props").write.text(path)
    lines = read_lines(spark, path)
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.min(F.length("value")).alias("min_len"),
        F.max(F.length("value")).alias("max_len"),
    )


def _stand_in_file_name():
    host = F.regexp_extract(F.col("url"), r"://([^/:]+)", 1)
    return F.concat(F.upper(host), F.col("page_id").cast("string"), F.lit(".txt.gz"))


def q_source_label(spark, sf):
    pages = _t(spark, sf, "pages")
    return pages.select("page_id", source_label(_stand_in_file_name()).alias("label"))


def q_json_compact(spark, sf):
    return _t(spark, sf, "events").select("event_id", compact_json("props").alias("source"))


def q_object_filter(spark, sf):
    lines = (
        _t(spark, sf, "events").select(F.col("props").alias("value"))
        .unionByName(_t(spark, sf, "benchmark").select(F.col("text").alias("value")))
        .unionByName(spark.createDataFrame([(x,) for x in EDGE_LINES], "value string"))
    )
    kind = F.when(is_json_object("value"), F.lit("object")).otherwise(F.lit("other"))
    return lines.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def q_doc_envelope(spark, sf):
    return envelope(_event_docs(spark, sf), "events", "event")


def q_text_as_doc(spark, sf):
    bm = _t(spark, sf, "benchmark")
    return bm.select("item_id", text_document("text").alias("source"))


def q_typed_projection(spark, sf):
    typed = typed_projection(_strict_docs(spark, sf), SAMPLE_MAPPING)
    return typed.select("_id", "a", "b")


def q_strict_fields(spark, sf):
    ev = _t(spark, sf, "events")
    extra = F.when(F.col("event_type") == "error", F.col("value"))
    body = F.to_json(F.struct(F.col("event_id").alias("a"), F.col("event_type").alias("b"), extra.alias("value")))
    docs = documents_from_columns(ev, id_col="event_id", routing_col="user_id", source=body)
    checked = validate(docs, SAMPLE_MAPPING)
    return checked.select("_id", F.col("_reason").isNull().alias("accepted"))


def q_reject_summary(spark, sf):
    return reject_summary(rejects(validate(_faulty_docs(spark, sf), SAMPLE_MAPPING)))


def _hash_keys(spark, sf):
    cust = _t(spark, sf, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("key")
    )
    docs = _t(spark, sf, "documents").select(
        F.lit("documents").alias("source"), F.col("doc_id").alias("id"), F.col("text").alias("key")
    )
    return cust.unionByName(docs)


def q_djb2_hash(spark, sf):
    return _hash_keys(spark, sf).select("source", "id", djb2_hash("key").alias("h"))


def q_hash_bucket(spark, sf):
    return _hash_keys(spark, sf).select("source", "id", hash_bucket("key", N).alias("bucket"))


def q_route_table(spark, sf):
    return route_table(spark, 16, candidates=_t(spark, sf, "orders").select("o_orderkey"))


def q_route_lookup(spark, sf):
    orders = _t(spark, sf, "orders")
    table = route_table(spark, N, candidates=orders.select("o_orderkey"))
    routed = orders.select("o_orderkey", (F.col("o_orderkey") % N).cast("string").alias("route"))
    return route_lookup(routed, "route", table).select("o_orderkey", "slot")


def q_spread_routes(spark, sf):
    docs = documents_from_table(_t(spark, sf, "documents"), "doc_id", source_cols=["doc_id"])
    return assign_shards(docs, N).select(F.col("doc_id"), F.col("_shard").alias("shard"))


def q_field_routing(spark, sf):
    ev = _t(spark, sf, "events")
    docs = documents_from_columns(ev, id_col="event_id", source="props", keep=["event_id"])
    return assign_shards(docs, N, routing=F.get_json_object("_source", "$.k")).select(
        "event_id", F.col("_shard").alias("shard")
    )


def q_shard_partition(spark, sf):
    docs = assign_shards(_event_docs(spark, sf), N)
    parted = shard_partition(docs, N).withColumn("pid", F.spark_partition_id())
    return parted.groupBy(F.col("_shard").alias("shard"), "pid").agg(F.count(F.lit(1)).alias("docs"))


def _events_grid(spark, sf):
    docs = assign_shards(_event_docs(spark, sf), N)
    per = docs.groupBy(F.col("_shard").alias("shard")).agg(F.count(F.lit(1)).alias("docs"))
    return shard_grid(spark, N, per)


def q_shard_skew(spark, sf):
    out = shard_skew(_events_grid(spark, sf))
    return out.select("shards", "max_docs", F.round("avg_docs", 6).alias("avg_docs"), F.round("ratio", 6).alias("ratio"))


def q_shard_counts(spark, sf):
    prepared = prepare(_faulty_docs(spark, sf), IndexSpec("events", N, mapping=SAMPLE_MAPPING))
    return shard_counts(spark, prepared, N)


def q_ingest_metrics(spark, sf):
    dest = _scratch(spark, "ingest_metrics")
    spec = IndexSpec("events", N, mapping=SAMPLE_MAPPING)
    m = ingest(spark, _faulty_docs(spark, sf), dest, spec, layout.new_generation())
    return spark.createDataFrame(
        [(int(m["scanned"]), int(m["rejects"]), int(m["bytes"]))], "docs bigint, rejects bigint, bytes bigint"
    )


def _conversation_docs(spark, sf):
    cv = _t(spark, sf, "conversations")
    docs = documents_from_table(cv, F.concat_ws("-", "conv_id", "turn"), routing_col="conv_id")
    return assign_shards(docs, N)


def q_shard_bytes(spark, sf):
    return shard_bytes(spark, _conversation_docs(spark, sf), N)


def q_largest_shard(spark, sf):
    return largest_shard(shard_bytes(spark, _conversation_docs(spark, sf), N))


def q_bulk_batches(spark, sf):
    li = _t(spark, sf, "lineitem")
    docs = documents_from_table(
        li, F.concat_ws("-", "l_orderkey", "l_linenumber"), routing_col="l_orderkey", source_cols=["l_orderkey", "l_linenumber"]
    )
    bulked = assign_bulks(assign_shards(docs, N), 1000, order=("_id",))
    return bulk_summary(bulked, 1000)


def q_bulk_ranks(spark, sf):
    docs = documents_from_table(_t(spark, sf, "orders"), "o_orderkey")
    return assign_bulks(assign_shards(docs, N), 1000, order=("_id",)).select("o_orderkey", "_shard", "_rank", "_bulk")


def q_latest_by_id(spark, sf):
    ev = _t(spark, sf, "events")
    docs = assign_shards(
        documents_from_columns(ev, id_col="user_id", seq_col="event_id", source="props", keep=["user_id", "event_id", "props"]),
        N,
    )
    return latest_by_id(docs).select("user_id", "event_id", "props")


def q_build_index(spark, sf):
    dest = _scratch(spark, "build_index")
    build_index(spark, _event_docs(spark, sf), dest, IndexSpec("events", N, type_name="event"))
    docs = restore_snapshot(spark, dest, "events")
    return docs.groupBy(F.col("_shard").cast("int").alias("shard")).agg(
        F.count(F.lit(1)).alias("docs"), F.min("_id").alias("min_id"), F.max("_id").alias("max_id")
    )


def q_shard_grid(spark, sf):
    ev = _t(spark, sf, "events")
    docs = assign_shards(documents_from_table(ev, "event_id", routing_col="event_type", source_cols=["event_id"]), N)
    per = docs.groupBy(F.col("_shard").alias("shard")).agg(F.count(F.lit(1)).alias("docs"))
    return shard_grid(spark, N, per)


def q_compact_shards(spark, sf):
    """Publish orders in small files (a target of a fifth of the table's file
    size: several files per shard), then compact the generation into one
    id-sorted file per shard."""
    orders = _t(spark, sf, "orders")
    small = max(16 * 1024, input_bytes(spark, orders) // 5)
    docs = documents_from_table(orders, "o_orderkey")
    dest = _scratch(spark, "compact_shards")
    build_index(spark, docs, dest, IndexSpec("orders", N, type_name="orders", target_file_bytes=small))
    res = compact_index(spark, dest, IndexSpec("orders", N, type_name="orders"))
    return res.manifest(spark).select("shard", "files")


def q_publish_layout(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "publish_layout")
    files = spark.read.parquet(layout.data_path(dest, "customer", res.generation))
    return files.groupBy(F.col("_shard").cast("int").alias("shard")).agg(F.count(F.lit(1)).alias("docs"))


def q_shard_manifest(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "shard_manifest")
    return res.manifest(spark).select("index", "snapshot", "shard", "docs", "bytes", "min_id", "max_id", "files")


def q_snapshot_manifest(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "snapshot_manifest")
    snap = latest_snapshot(spark, dest, "customer")
    return spark.createDataFrame(
        [(snap["index"], snap["snapshot"], snap["shards"], snap["docs"], snap["bytes"], snap["rejects"])],
        "index string, snapshot string, shards int, docs bigint, bytes bigint, rejects bigint",
    )


def q_restore_snapshot(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "restore_snapshot")
    cols = _t(spark, sf, "customer").columns
    return restore_snapshot(spark, dest, "customer").select(*cols)


def q_verify_snapshot(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "verify_snapshot")
    return verify_snapshot(spark, dest, "customer").select("shard", "ok")


def _customer_changes(spark, sf):
    cust = _t(spark, sf, "customer")
    moved = cust.where(F.col("c_mktsegment") == "AUTOMOBILE").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    sup = _t(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1_000_000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return moved.unionByName(sup)


def q_upsert_docs(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "upsert_docs")
    changes = documents_from_table(_customer_changes(spark, sf), "c_custkey", seq_col=F.lit(1))
    upsert(spark, changes, dest, IndexSpec("customer", N, type_name="customer"))
    cols = _t(spark, sf, "customer").columns
    return restore_snapshot(spark, dest, "customer").select(*cols)


def q_upsert_delta(spark, sf):
    """The same changes as ``upsert_docs``, applied as a delta layer (no shard
    rewritten) and read back through the layers."""
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "upsert_delta")
    changes = documents_from_table(_customer_changes(spark, sf), "c_custkey", seq_col=F.lit(1))
    upsert(spark, changes, dest, IndexSpec("customer", N, type_name="customer"), mode="delta")
    cols = _t(spark, sf, "customer").columns
    return restore_snapshot(spark, dest, "customer").select(*cols)


def q_upsert_modes(spark, sf):
    """The same changes in each upsert mode: what is read back, what the commit row counts, and whether all shards verify."""
    changes = documents_from_table(_customer_changes(spark, sf), "c_custkey", seq_col=F.lit(1))
    parts = []
    for mode in ("rewrite", "delta", "auto"):
        dest, res = _publish_table(spark, sf, "customer", "c_custkey", f"upsert_modes_{mode}")
        upsert(spark, changes, dest, IndexSpec("customer", N, type_name="customer"), mode=mode)
        counted = latest_snapshot(spark, dest, "customer")["docs"]
        sound = verify_snapshot(spark, dest, "customer").where("NOT ok").isEmpty()
        parts.append(
            restore_snapshot(spark, dest, "customer").agg(
                F.lit(mode).alias("mode"),
                F.count(F.lit(1)).alias("docs"),
                F.count(F.when(F.col("c_mktsegment") == "SUPPLIER", 1)).alias("suppliers"),
                F.lit(counted).cast("bigint").alias("counted"),
                F.lit(sound).alias("sound"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_compact_copies(spark, sf):
    """Texts without ids, copies kept, compacted by a spec that says nothing of copies: none may go."""
    texts = _t(spark, sf, "conversations").select(F.coalesce("text", F.lit("")).alias("value"))
    dest = _scratch(spark, "compact_copies")
    build_index(spark, documents_from_lines(texts, fmt="text"), dest, IndexSpec("texts", N, dedup=False))
    compact_index(spark, dest, IndexSpec("texts", N), shards=list(range(N)))
    sound = verify_snapshot(spark, dest, "texts").where("NOT ok").isEmpty()
    return restore_snapshot(spark, dest, "texts").agg(
        F.count(F.lit(1)).alias("docs"), F.count_distinct("_id").alias("texts"), F.lit(sound).alias("sound")
    )


def q_verify_damaged(spark, sf):
    """Customers routed by segment; then one segment's shard loses its folder, another's the rows of the segment."""
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "verify_damaged", routing_col="c_mktsegment")
    thinned = layout.shard_path(dest, "customer", res.generation, bucket_py("MACHINERY", N))
    rest = _scratch(spark, "verify_damaged_rest")
    spark.read.parquet(thinned).where("c_mktsegment <> 'MACHINERY'").write.parquet(rest)
    spark.read.parquet(rest).write.mode("overwrite").parquet(thinned)
    delete_path(spark, layout.shard_path(dest, "customer", res.generation, bucket_py("BUILDING", N)))
    return verify_snapshot(spark, dest, "customer").select("shard", "ok", "reason", "file_reason")


def q_commit_race(spark, sf):
    """Two updates of one parent at once, a delta and a rewrite: one is kept, the other refused, nothing of it is read."""
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "commit_race")
    auto = _t(spark, sf, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")

    def update(mode: str, name: str) -> bool:
        changes = documents_from_table(auto.withColumn("c_name", F.lit(name)), "c_custkey", seq_col=F.lit(1))
        try:
            upsert(spark, changes, dest, IndexSpec("customer", N, type_name="customer"), mode=mode, parent=res.generation)
        except ConcurrentUpdateError:
            return False
        return True

    with ThreadPoolExecutor(2) as pool:
        kept = [f.result() for f in [pool.submit(update, "delta", "first"), pool.submit(update, "rewrite", "second")]]
    winner = "first" if kept[0] else "second"
    sound = verify_snapshot(spark, dest, "customer").where("NOT ok").isEmpty()
    return restore_snapshot(spark, dest, "customer").agg(
        F.lit(sum(kept)).cast("bigint").alias("kept"),
        F.lit(latest_snapshot(spark, dest, "customer")["commit_no"]).cast("bigint").alias("commits"),
        F.count(F.lit(1)).alias("docs"),
        F.count(F.when(F.col("c_name") == winner, 1)).alias("changed"),
        F.count(F.when(F.col("c_name").isin("first", "second") & (F.col("c_name") != winner), 1)).alias("of_the_other"),
        F.lit(sound).alias("sound"),
    )


def q_verify_files(spark, sf):
    """Customers with a layer of changes, then the files of one shard's base are lost: sums by generation of what the files hold."""
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "verify_files", routing_col="c_mktsegment")
    changes = documents_from_table(_customer_changes(spark, sf), "c_custkey", routing_col="c_mktsegment", seq_col=F.lit(1))
    upsert(spark, changes, dest, IndexSpec("customer", N, type_name="customer"), mode="delta")
    delete_path(spark, layout.shard_path(dest, "customer", res.generation, bucket_py("BUILDING", N)))
    each = verify_files(spark, dest, "customer").withColumn("base", F.col("gen") == res.generation)
    return each.groupBy("shard", "base").agg(
        F.max("reason").alias("reason"), F.sum("docs").alias("docs"), F.sum("expected_docs").alias("expected_docs"), F.sum("live_docs").alias("live_docs")
    )


def q_load_template(spark, sf):
    """A template file read from storage; orders as JSON lines typed by it."""
    path = f"{_scratch(spark, 'load_template')}/orders.json"
    put_if_absent(spark, path, ORDER_TEMPLATE)
    mapping = load_template(spark, path, "order")
    orders = _t(spark, sf, "orders")
    body = F.to_json(F.struct("o_orderkey", F.struct(F.col("o_custkey").alias("key")).alias("cust"), "o_totalprice", "o_orderpriority"))
    typed = typed_projection(documents_from_lines(orders.select(body.alias("value")), id_field="o_orderkey"), mapping)
    return typed.select("_id", "o_orderkey", F.col("cust.key").alias("custkey"), "o_totalprice", "o_orderpriority")


# Mapping of the documents of ``load_template``.
ORDER_TEMPLATE = """
{"template": "orders*", "mappings": {"order": {"dynamic": "strict", "properties": {
   "o_orderkey": {"type": "long"}, "cust": {"properties": {"key": {"type": "long"}}},
   "o_totalprice": {"type": "double"}, "o_orderpriority": {"type": "string"}}}}}
"""


def q_missing_id(spark, sf):
    """Events as JSON lines whose id is written only if their user has an even number; the others are refused."""
    ev = _t(spark, sf, "events")
    body = F.to_json(F.struct(F.when(F.col("user_id") % 2 == 0, F.col("event_id")).alias("id"), "event_type"))
    dest = _scratch(spark, "missing_id")
    res = build_index(spark, documents_from_lines(ev.select(body.alias("value")), id_field="id"), dest, IndexSpec("events", N))
    kept = restore_snapshot(spark, dest, "events").agg(F.lit("stored").alias("reason"), F.count(F.lit(1)).alias("n"))
    return reject_summary(res.rejects(spark)).unionByName(kept)


def q_stored_alias(spark, sf):
    """An alias is stored for one index, then moved to another, which is opened by it."""
    dest = _scratch(spark, "stored_alias")
    for seq, (table, key) in enumerate((("customer", "c_custkey"), ("supplier", "s_suppkey"))):
        build_index(spark, documents_from_table(_t(spark, sf, table), key), dest, IndexSpec(table, N, type_name=table))
        add_alias(spark, dest, "partners", table, seq)
    docs, shards = open_index(spark, dest, "partners")
    return docs.select("s_suppkey", "s_name", F.lit(shards).alias("shards"))


def q_lookup_ids(spark, sf):
    """Customers whose number is that of a nation, read by id through an alias: each from the shard that holds it."""
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "lookup_ids")
    add_alias(spark, dest, "clients", "customer", 1)
    ids = [str(r.n_nationkey) for r in _t(spark, sf, "nation").select("n_nationkey").collect()]  # the 25 nations
    return lookup(spark, dest, "clients", ids).select("_id", "c_custkey", "c_name", F.col("_shard").cast("int").alias("shard"))


def q_nested_fields(spark, sf):
    """Turns as an array of objects.  The turn's number decides the fault: 1 -> undeclared member two levels down,
    2 -> an object where text is declared, 3 -> a number where an object is."""
    turn = F.col("turn")
    talk = lambda element: F.to_json(F.struct(F.array(element).alias("turns")))
    body = (
        F.when(turn == 1, talk(F.struct("turn", F.struct("role", F.lit(1).alias("zzz")).alias("who"))))
        .when(turn == 2, talk(F.struct("turn", F.struct(F.struct("role").alias("role")).alias("who"))))
        .when(turn == 3, talk(turn))
        .otherwise(talk(F.struct("turn", F.struct("role").alias("who"))))
    )
    cv = _t(spark, sf, "conversations")
    docs = documents_from_columns(cv, id_col=F.concat_ws("-", "conv_id", "turn"), source=body, keep=["conv_id", "turn"])
    checked = validate(docs, parse_template(TALK_TEMPLATE))
    return checked.select("conv_id", "turn", F.col("_reason").alias("reason"), F.col("_field").alias("field"))


# Mapping of the documents of ``nested_fields``.
TALK_TEMPLATE = """
{"mappings": {"talk": {"dynamic": "strict", "properties": {"turns": {"type": "nested", "properties": {
   "turn": {"type": "integer"}, "who": {"properties": {"role": {"type": "string"}}}}}}}}}
"""


def q_resolve_alias(spark, sf):
    nation = _t(spark, sf, "nation")
    region = _t(spark, sf, "region")
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.lower("r_name").alias("alias"), F.lower("n_name").alias("index"), F.col("n_nationkey").cast("bigint").alias("seq")
    )
    return resolve_aliases(rows)


def _part_index(spark, sf, name):
    dest, res = _publish_table(spark, sf, "part", "p_partkey", name)
    return restore_snapshot(spark, dest, "part")


def q_search_term(spark, sf):
    idx = _part_index(spark, sf, "search_term")
    return search(idx, term("p_brand", "Brand#1", "Brand#13", "Brand#22"), columns=["p_partkey", "p_brand"])


def q_search_range(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "search_range")
    idx = restore_snapshot(spark, dest, "customer")
    cond = range_("c_acctbal", gte=1000.0, lt=5000.0) & term("c_mktsegment", "BUILDING")
    return search(idx, cond, columns=["c_custkey", "c_acctbal"])


def q_search_topk(spark, sf):
    dest, res = _publish_table(spark, sf, "orders", "o_orderkey", "search_topk")
    idx = restore_snapshot(spark, dest, "orders")
    return search(
        idx, columns=["o_orderkey", "o_totalprice"], sort=[F.desc("o_totalprice"), F.asc("o_orderkey")], size=50
    )


def q_get_by_id(spark, sf):
    dest, res = _publish_table(spark, sf, "customer", "c_custkey", "get_by_id")
    idx = restore_snapshot(spark, dest, "customer")
    wanted = _t(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").cast("string").alias("_id")
    )
    return multi_get(idx, N, wanted).select("c_custkey", F.col("_shard").cast("int").alias("shard"))


# Mapping of the versioned event documents used by the stream.
STREAM_TEMPLATE = """
{"mappings": {"event": {"dynamic": "strict", "properties": {
   "u": {"type": "long"}, "e": {"type": "long"}, "props": {"type": "string"}}}}}
"""


def q_stream_upsert(spark, sf):
    """Versioned event documents (id = user, version = event id) arrive as JSON
    lines, one folder per event type, and are applied by the streaming
    upsert sink in three micro-batches; the index then holds each user's
    latest event, the same as a batch last-write-wins."""
    mapping = parse_template(STREAM_TEMPLATE)
    spec = IndexSpec("events_by_user", N, mapping=mapping)
    dest = _scratch(spark, "stream_upsert")
    empty = spark.createDataFrame([], "value string")
    build_index(spark, documents_from_lines(empty, id_field="u", seq_field="e"), dest, spec)
    inbox = _scratch(spark, "stream_inbox")
    ev = _t(spark, sf, "events")
    body = F.to_json(F.struct(F.col("user_id").alias("u"), F.col("event_id").alias("e"), "props"))
    ev.select(body.alias("value"), "event_type").write.partitionBy("event_type").text(inbox)
    n_files = len(spark.read.text(inbox).inputFiles())
    q = start_upsert_stream(
        spark, inbox, dest, spec, id_field="u", seq_field="e", checkpoint=_scratch(spark, "stream_ckpt"),
        query_name="stream_upsert", trigger={"availableNow": True}, max_files_per_trigger=-(-n_files // 3),
    )
    if not q.awaitTermination(600):  # availableNow ends by itself; never wait forever
        q.stop()
        raise TimeoutError("stream_upsert: the stream did not finish within 600 s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    out = restore_snapshot(spark, dest, "events_by_user")
    return out.select(F.col("u").alias("user_id"), F.col("e").alias("event_id"), "props")


def q_term_stats(spark, sf):
    idx = _part_index(spark, sf, "term_stats")
    return term_stats(idx, ["p_brand", "p_type"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_lines": q_scan_lines,
    "source_label": q_source_label,
    "json_compact": q_json_compact,
    "object_filter": q_object_filter,
    "doc_envelope": q_doc_envelope,
    "text_as_doc": q_text_as_doc,
    "typed_projection": q_typed_projection,
    "strict_fields": q_strict_fields,
    "reject_summary": q_reject_summary,
    "djb2_hash": q_djb2_hash,
    "hash_bucket": q_hash_bucket,
    "route_table": q_route_table,
    "route_lookup": q_route_lookup,
    "spread_routes": q_spread_routes,
    "field_routing": q_field_routing,
    "shard_partition": q_shard_partition,
    "shard_skew": q_shard_skew,
    "shard_counts": q_shard_counts,
    "ingest_metrics": q_ingest_metrics,
    "shard_bytes": q_shard_bytes,
    "largest_shard": q_largest_shard,
    "bulk_batches": q_bulk_batches,
    "bulk_ranks": q_bulk_ranks,
    "latest_by_id": q_latest_by_id,
    "build_index": q_build_index,
    "shard_grid": q_shard_grid,
    "compact_shards": q_compact_shards,
    "publish_layout": q_publish_layout,
    "shard_manifest": q_shard_manifest,
    "snapshot_manifest": q_snapshot_manifest,
    "restore_snapshot": q_restore_snapshot,
    "verify_snapshot": q_verify_snapshot,
    "upsert_docs": q_upsert_docs,
    "upsert_delta": q_upsert_delta,
    "upsert_modes": q_upsert_modes,
    "compact_copies": q_compact_copies,
    "verify_damaged": q_verify_damaged,
    "verify_files": q_verify_files,
    "commit_race": q_commit_race,
    "nested_fields": q_nested_fields,
    "load_template": q_load_template,
    "missing_id": q_missing_id,
    "resolve_alias": q_resolve_alias,
    "stored_alias": q_stored_alias,
    "lookup_ids": q_lookup_ids,
    "search_term": q_search_term,
    "search_range": q_search_range,
    "search_topk": q_search_topk,
    "get_by_id": q_get_by_id,
    "term_stats": q_term_stats,
    "stream_upsert": q_stream_upsert,
}


# ----------------------------------------------------------------- oracle ----

def _duck_djb2(expr: str) -> str:
    """DJB2 over UTF-16 code units in DuckDB SQL; characters above U+FFFF
    count as their two surrogate units (33^2 = 1089)."""
    fold = (
        f"list_reduce(list_prepend(5381::BIGINT, list_transform(string_split({expr}, ''), "
        "lambda ch: unicode(ch)::BIGINT)), lambda a, c: CASE WHEN c > 65535 THEN "
        "(a * 1089 + (55296 + ((c - 65536) >> 10)) * 33 + (56320 + ((c - 65536) & 1023))) & 4294967295 "
        "ELSE (a * 33 + c) & 4294967295 END)"
    )
    return f"(CASE WHEN ({expr}) = '' THEN 5381::BIGINT ELSE ((({fold}) + 2147483648) & 4294967295) - 2147483648 END)"


def _duck_bucket(expr: str, n: int = N) -> str:
    return f"CAST(abs({_duck_djb2(expr)} % {n}) AS INTEGER)"


def _json_ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%S.%f')"


_EVENT_JSON = (
    "json_object('event_id', event_id, 'ts', " + _json_ts("ts") + ", 'user_id', user_id, "
    "'event_type', event_type, 'value', value, 'props', props)::VARCHAR"
)
_CUSTOMER_JSON = (
    "json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey, "
    "'c_acctbal', c_acctbal, 'c_mktsegment', c_mktsegment)::VARCHAR"
)
_CONV_JSON = "json_object('conv_id', conv_id, 'turn', turn, 'role', role, 'text', text)::VARCHAR"
_FAULTY_SOURCE = """CASE event_type
    WHEN 'error' THEN json_object('a', event_id, 'b', event_type, 'value', value)::VARCHAR
    WHEN 'click' THEN json_object('a', value, 'b', event_type)::VARCHAR
    WHEN 'purchase' THEN to_json([CAST(event_id AS VARCHAR), event_type])::VARCHAR
    WHEN 'view' THEN json_object('a', CAST(event_id AS VARCHAR), 'b', event_type)::VARCHAR
    ELSE json_object('a', event_id, 'b', event_type)::VARCHAR END"""
_FAULTY_REASON = """CASE event_type WHEN 'error' THEN 'undeclared_field'
    WHEN 'click' THEN CASE WHEN value <> floor(value) THEN 'wrong_type' END
    WHEN 'purchase' THEN 'not_an_object' ELSE NULL END"""


def _grid(per_shard_sql: str, cols: str) -> str:
    return (
        f"SELECT g.shard, {cols} FROM (SELECT CAST(i AS INTEGER) AS shard FROM range({N}) t(i)) g "
        f"LEFT JOIN ({per_shard_sql}) p USING (shard)"
    )


def oracle_sql() -> dict[str, str]:
    edge_values = ", ".join("('" + x.replace("'", "''") + "')" for x in EDGE_LINES)
    bucket_user = _duck_bucket("CAST(user_id AS VARCHAR)")
    cust_bucket = _duck_bucket("CAST(c_custkey AS VARCHAR)")
    conv_bytes = (
        f"SELECT {_duck_bucket('CAST(conv_id AS VARCHAR)')} AS shard, "
        f"CAST(sum(strlen({_CONV_JSON})) AS BIGINT) AS bytes FROM conversations GROUP BY 1"
    )
    route16 = (
        f"SELECT bucket, min(o_orderkey) AS x FROM (SELECT o_orderkey, "
        f"{_duck_bucket('CAST(o_orderkey AS VARCHAR)', 16)} AS bucket FROM orders) GROUP BY bucket"
    )
    route8 = (
        f"SELECT CAST(row_number() OVER (ORDER BY x) - 1 AS INTEGER) AS slot, CAST(x AS VARCHAR) AS route "
        f"FROM (SELECT bucket, min(o_orderkey) AS x FROM (SELECT o_orderkey, "
        f"{_duck_bucket('CAST(o_orderkey AS VARCHAR)')} AS bucket FROM orders) GROUP BY bucket)"
    )
    li_counts = (
        f"SELECT {_duck_bucket('CAST(l_orderkey AS VARCHAR)')} AS shard, count(*) AS c FROM lineitem GROUP BY 1"
    )
    customer_cols = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
    manifest_cust = (
        f"SELECT 'customer' AS index, 'snapshot_customer' AS snapshot, {cust_bucket} AS shard, "
        f"count(*) AS docs, CAST(sum(strlen({_CUSTOMER_JSON})) AS BIGINT) AS bytes, "
        f"min(CAST(c_custkey AS VARCHAR)) AS min_id, max(CAST(c_custkey AS VARCHAR)) AS max_id, "
        f"CAST(1 AS BIGINT) AS files FROM customer GROUP BY 3"
    )
    return {
        **CORPUS_SQL,
        "bulk_ranks": f"SELECT o_orderkey, _shard, row_number() OVER w - 1 AS _rank, (row_number() OVER w - 1) // 1000 AS _bulk "
        f"FROM (SELECT o_orderkey, {_duck_bucket('CAST(o_orderkey AS VARCHAR)')} AS _shard FROM orders) "
        "WINDOW w AS (PARTITION BY _shard ORDER BY CAST(o_orderkey AS VARCHAR))",
        "scan_lines": "SELECT count(*) AS lines, CAST(min(length(props)) AS INTEGER) AS min_len, "
        "CAST(max(length(props)) AS INTEGER) AS max_len FROM events",
        "source_label": "SELECT page_id, regexp_replace(upper(regexp_extract(url, '://([^/:]+)', 1)) || "
        "CAST(page_id AS VARCHAR) || '.txt.gz', '\\d.txt.gz', '', 'g') AS label FROM pages",
        "json_compact": "SELECT event_id, json(props)::VARCHAR AS source FROM events",
        "object_filter": "SELECT CASE WHEN json_valid(v) AND json_type(v) = 'OBJECT' THEN 'object' ELSE 'other' END "
        "AS kind, count(*) AS n FROM (SELECT props AS v FROM events UNION ALL SELECT text FROM benchmark "
        f"UNION ALL SELECT * FROM (VALUES {edge_values}) t(v)) GROUP BY 1",
        "doc_envelope": "SELECT 'events' AS _index, 'event' AS _type, CAST(event_id AS VARCHAR) AS _id, "
        f"CAST(user_id AS VARCHAR) AS _routing, {_EVENT_JSON} AS _source FROM events",
        "text_as_doc": "SELECT item_id, json_object('value', text)::VARCHAR AS source FROM benchmark",
        "typed_projection": "SELECT CAST(event_id AS VARCHAR) AS _id, CAST(event_id AS INTEGER) AS a, "
        "event_type AS b FROM events",
        "strict_fields": "SELECT CAST(event_id AS VARCHAR) AS _id, event_type <> 'error' AS accepted FROM events",
        "reject_summary": f"SELECT reason, count(*) AS n FROM (SELECT {_FAULTY_REASON} AS reason FROM events) "
        "WHERE reason IS NOT NULL GROUP BY 1",
        "djb2_hash": f"SELECT 'customer' AS source, c_custkey AS id, {_duck_djb2('c_name')} AS h FROM customer "
        f"UNION ALL SELECT 'documents', doc_id, {_duck_djb2('text')} FROM documents",
        "hash_bucket": f"SELECT 'customer' AS source, c_custkey AS id, {_duck_bucket('c_name')} AS bucket FROM customer "
        f"UNION ALL SELECT 'documents', doc_id, {_duck_bucket('text')} FROM documents",
        "route_table": "SELECT CAST(row_number() OVER (ORDER BY x) - 1 AS INTEGER) AS slot, "
        f"CAST(x AS VARCHAR) AS route, bucket FROM ({route16})",
        "route_lookup": f"SELECT o.o_orderkey, r.slot FROM orders o JOIN ({route8}) r "
        f"ON CAST(o.o_orderkey % {N} AS VARCHAR) = r.route",
        "spread_routes": f"SELECT doc_id, {_duck_bucket('CAST(doc_id AS VARCHAR)')} AS shard FROM documents",
        "field_routing": f"SELECT event_id, {_duck_bucket("(props->>'k')")} AS shard FROM events",
        "shard_partition": f"SELECT {bucket_user} AS shard, {bucket_user} AS pid, count(*) AS docs FROM events GROUP BY 1, 2",
        "shard_skew": "SELECT CAST(count(*) AS BIGINT) AS shards, CAST(max(docs) AS BIGINT) AS max_docs, "
        "round(avg(docs), 6) AS avg_docs, round(max(docs) / avg(docs), 6) AS ratio FROM ("
        + _grid(f"SELECT {bucket_user} AS shard, count(*) AS d FROM events GROUP BY 1", "coalesce(p.d, 0) AS docs")
        + ")",
        "shard_counts": _grid(
            f"SELECT {bucket_user} AS shard, count(*) AS s, count(*) FILTER (WHERE ({_FAULTY_REASON}) IS NULL) AS a "
            "FROM events GROUP BY 1",
            "coalesce(p.s, 0) AS submitted, coalesce(p.a, 0) AS accepted",
        ),
        "ingest_metrics": f"SELECT count(*) AS docs, count(*) FILTER (WHERE ({_FAULTY_REASON}) IS NOT NULL) AS rejects, "
        f"CAST(coalesce(sum(strlen({_FAULTY_SOURCE})) FILTER (WHERE ({_FAULTY_REASON}) IS NULL), 0) AS BIGINT) AS bytes FROM events",
        "shard_bytes": _grid(conv_bytes, "coalesce(p.bytes, 0) AS bytes"),
        "largest_shard": "SELECT shard, bytes FROM (" + _grid(conv_bytes, "coalesce(p.bytes, 0) AS bytes")
        + ") ORDER BY bytes DESC, shard ASC LIMIT 1",
        "bulk_batches": f"SELECT shard, CAST(ceil(c / 1000) AS BIGINT) AS bulks, "
        f"CAST(c - (ceil(c / 1000) - 1) * 1000 AS BIGINT) AS last_bulk_docs FROM ({li_counts})",
        "latest_by_id": "SELECT user_id, event_id, props FROM (SELECT user_id, event_id, props, "
        "row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1",
        "build_index": f"SELECT {bucket_user} AS shard, count(*) AS docs, min(CAST(event_id AS VARCHAR)) AS min_id, "
        "max(CAST(event_id AS VARCHAR)) AS max_id FROM events GROUP BY 1",
        "shard_grid": _grid(
            f"SELECT {_duck_bucket('event_type')} AS shard, count(*) AS d FROM events GROUP BY 1",
            "coalesce(p.d, 0) AS docs",
        ),
        "compact_shards": f"SELECT DISTINCT {_duck_bucket('CAST(o_orderkey AS VARCHAR)')} AS shard, "
        "CAST(1 AS BIGINT) AS files FROM orders",
        "publish_layout": f"SELECT {cust_bucket} AS shard, count(*) AS docs FROM customer GROUP BY 1",
        "shard_manifest": manifest_cust,
        "snapshot_manifest": f"SELECT 'customer' AS index, 'snapshot_customer' AS snapshot, {N} AS shards, "
        f"count(*) AS docs, CAST(sum(strlen({_CUSTOMER_JSON})) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS rejects "
        "FROM customer",
        "restore_snapshot": f"SELECT {customer_cols} FROM customer",
        "verify_snapshot": f"SELECT DISTINCT {cust_bucket} AS shard, true AS ok FROM customer",
        "upsert_docs": f"SELECT {customer_cols} FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey "
        f"ORDER BY seq DESC) AS rn FROM (SELECT {customer_cols}, 0 AS seq FROM customer UNION ALL "
        f"SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment, 1 FROM customer "
        "WHERE c_mktsegment = 'AUTOMOBILE' UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, "
        "s_acctbal, 'SUPPLIER', 1 FROM supplier)) WHERE rn = 1",
        "upsert_delta": f"SELECT {customer_cols} FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey "
        f"ORDER BY seq DESC) AS rn FROM (SELECT {customer_cols}, 0 AS seq FROM customer UNION ALL "
        f"SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment, 1 FROM customer "
        "WHERE c_mktsegment = 'AUTOMOBILE' UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, "
        "s_acctbal, 'SUPPLIER', 1 FROM supplier)) WHERE rn = 1",
        "upsert_modes": "SELECT mode, docs, suppliers, docs AS counted, true AS sound FROM (VALUES ('rewrite'), ('delta'), ('auto')) m(mode), "
        "(SELECT count(DISTINCT k) AS docs FROM (SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey + 1000000 FROM supplier)), "
        "(SELECT count(*) AS suppliers FROM supplier)",
        "compact_copies": "SELECT count(*) AS docs, count(DISTINCT coalesce(text, '')) AS texts, true AS sound FROM conversations",
        "verify_damaged": f"SELECT shard, reason IS NULL AS ok, reason, CASE WHEN reason IS NOT NULL THEN 'missing_file' END AS file_reason FROM (SELECT shard, CASE WHEN shard = {_duck_bucket(chr(39) + 'BUILDING' + chr(39))} "
        f"THEN 'missing_folder' WHEN shard = {_duck_bucket(chr(39) + 'MACHINERY' + chr(39))} THEN 'docs' END AS reason "
        f"FROM (SELECT CAST(i AS INTEGER) AS shard FROM range({N}) t(i)))",
        "verify_files": f"""
WITH base AS (SELECT c_custkey, {_duck_bucket('c_mktsegment')} AS shard, c_mktsegment = 'AUTOMOBILE' AS moved FROM customer),
stored AS (
  SELECT shard, true AS base, count(*) AS expected_docs, count(*) FILTER (NOT moved) AS live FROM base GROUP BY shard
  UNION ALL
  SELECT shard, false, count(*), count(*) FROM (SELECT shard FROM base WHERE moved UNION ALL
    SELECT {_duck_bucket("'SUPPLIER'")} FROM supplier) GROUP BY shard)
SELECT shard, base, CASE WHEN gone THEN 'missing_file' END AS reason, CASE WHEN gone THEN 0 ELSE expected_docs END AS docs,
  expected_docs, CASE WHEN gone THEN 0 ELSE live END AS live_docs
FROM (SELECT *, base AND shard = {_duck_bucket("'BUILDING'")} AS gone FROM stored)""",
        "commit_race": "SELECT 1 AS kept, 2 AS commits, count(*) AS docs, count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS changed, "
        "0 AS of_the_other, true AS sound FROM customer",
        "load_template": "SELECT o_orderkey::VARCHAR AS _id, o_orderkey, o_custkey AS custkey, o_totalprice, o_orderpriority FROM orders",
        "missing_id": "SELECT CASE WHEN user_id % 2 = 0 THEN 'stored' ELSE 'missing_id' END AS reason, count(*) AS n FROM events GROUP BY 1",
        "stored_alias": f"SELECT s_suppkey, s_name, {N} AS shards FROM supplier",
        "lookup_ids": f"SELECT c_custkey::VARCHAR AS _id, c_custkey, c_name, {cust_bucket} AS shard FROM customer "
        "WHERE c_custkey IN (SELECT n_nationkey FROM nation)",
        "nested_fields": "SELECT conv_id, turn, CASE turn WHEN 1 THEN 'undeclared_field' WHEN 2 THEN 'wrong_type' WHEN 3 THEN 'wrong_type' END "
        "AS reason, CASE WHEN turn IN (1, 2, 3) THEN 'turns' END AS field FROM conversations",
        "resolve_alias": "SELECT alias, index FROM (SELECT lower(r_name) AS alias, lower(n_name) AS index, "
        "row_number() OVER (PARTITION BY lower(r_name) ORDER BY n_nationkey DESC, lower(n_name) DESC) AS rn "
        "FROM nation JOIN region ON n_regionkey = r_regionkey) WHERE rn = 1",
        "search_term": "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#13', 'Brand#22')",
        "search_range": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 1000.0 AND c_acctbal < 5000.0 "
        "AND c_mktsegment = 'BUILDING'",
        "search_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 50",
        "get_by_id": f"SELECT c_custkey, {cust_bucket} AS shard FROM customer WHERE c_custkey IN "
        "(SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
        "term_stats": "SELECT 'p_brand' AS field, p_brand AS term, count(*) AS docs FROM part GROUP BY 2 "
        "UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY 2",
        "stream_upsert": "SELECT user_id, event_id, props FROM (SELECT user_id, event_id, props, "
        "row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1",
    }


# ----------------------------------------------------------------- driver ----

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: build an 8-shard index of ``events`` (routed by user) from
    sf0.001, commit it, read it back and report ``shard, docs, bytes``."""
    sf = "/root/testdata/sf0.001"
    dest = _scratch(spark, "entry")
    build_index(spark, _event_docs(spark, sf), dest, IndexSpec("events", N, type_name="event"))
    return read_manifest(spark, dest, "events").select("shard", "docs", "bytes").orderBy("shard")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **CORPUS_QUERIES}
