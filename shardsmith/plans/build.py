"""Build, publish, verify and commit an index.

One build is four Spark jobs plus two n-row driver steps:

1. **ingest** (map only, no shuffle): validate, route and fingerprint every
   document; write it once, partitioned by ``_status`` (accepted/rejected).
   The rejected part *is* the rejects table.  Metrics are gathered with
   ``observe`` in the same pass.
2. **size** (driver, n rows): per-shard count and bytes, read from the staged
   ``_shard``/``_bytes`` columns only.  Each shard gets ``k`` write tasks so
   no task holds more than ``target_file_bytes`` (a hot shard is split, it is
   never truncated).
3. **publish**: ONE shuffle, ``repartitionById`` on a partition id that
   encodes (shard, slice of ids); last write wins per (shard, id) on the same
   exchange; the window's sort also orders each file by id; partitioned write
   ``_shard=<k>``.
4. **manifest**: a table with a row for each written file (docs, bytes,
   checksum, ids, key slices), read back from small columns; its sums by shard
   are the manifest.  They must be what the write job saw, and the rows that
   its winners stand for must be all that ingest accepted.
5. **commit** (driver, one row): the next number of the commit log.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.functions.hashing import hash_bucket
from shardsmith.operators.routing import checked_shard
from shardsmith.functions.jsonfn import is_json_object
from shardsmith.operators.validate import MISSING_ID, NOT_AN_OBJECT, PARSED, validate
from shardsmith.plans import commits, files, layout
from shardsmith.sources.template import Mapping

class ConcurrentUpdateError(RuntimeError):
    """Another writer committed a newer generation of the same index."""


ACCEPTED = "accepted"
REJECTED = "rejected"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("docs", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("min_id", T.StringType()),
        T.StructField("max_id", T.StringType()),
        T.StructField("checksum", T.LongType()),
        T.StructField("files", T.LongType()),
        T.StructField("file_bytes", T.LongType()),
        T.StructField("data_gen", T.StringType()),
        # delta layers (upsert mode "delta"): rows in the base generation, the
        # delta generations on top of it (oldest first) and their row count
        T.StructField("base_docs", T.LongType()),
        T.StructField("delta_gens", T.StringType()),
        T.StructField("delta_docs", T.LongType()),
        # the generation whose masks say which stored rows are replaced, and
        # the bytes that these bitmaps take at most (0: none)
        T.StructField("mask_gen", T.StringType()),
        T.StructField("mask_bytes", T.LongType()),
    ]
)

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("snapshot", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("parent", T.StringType()),
        T.StructField("shards", T.IntegerType()),
        T.StructField("docs", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("checksum", T.LongType()),
        T.StructField("rejects", T.LongType()),
        T.StructField("data_schema", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField("tag", T.StringType()),
        # the last batch of each streaming query that has written to the index
        T.StructField("batches", T.MapType(T.StringType(), T.LongType())),
        T.StructField("dedup", T.BooleanType()),
        T.StructField("commit_no", T.LongType()),
    ]
)


@dataclass
class IndexSpec:
    index: str
    shards: int
    type_name: str = "_doc"
    mapping: Mapping | None = None
    numeric_text: bool = True
    dedup: bool = True
    # ~1 GiB per write task: 100 TB -> ~100k tasks/files (row groups stay 128 MB)
    target_file_bytes: int = 1024 * 1024 * 1024
    keep_staging: bool = False  # keep the staged accepted copy after commit

    def __post_init__(self) -> None:
        if not isinstance(self.shards, int) or self.shards < 1:
            raise ValueError(f"shards must be a positive int, got {self.shards!r}")
        if self.target_file_bytes < 1:
            raise ValueError(f"target_file_bytes must be positive, got {self.target_file_bytes!r}")
        if not self.index or "/" in self.index:
            raise ValueError(f"bad index name {self.index!r}")
        if self.mapping is not None and self.type_name == "_doc":
            self.type_name = self.mapping.type_name


@dataclass
class BuildResult:
    dest: str
    index: str
    generation: str
    shards: int
    metrics: dict = field(default_factory=dict)

    def manifest(self, spark: SparkSession) -> DataFrame:
        return read_manifest(spark, self.dest, self.index, self.generation)

    def rejects(self, spark: SparkSession) -> DataFrame:
        return read_rejects(spark, self.dest, self.index, self.generation)


# ---------------------------------------------------------------- ingest ----

def prepare(docs: DataFrame, spec: IndexSpec) -> DataFrame:
    """Validate (if a mapping is given), route, fingerprint; adds ``_status``."""
    if spec.mapping is not None:
        checked = validate(docs, spec.mapping, numeric_text=spec.numeric_text)
    else:
        checked = docs.withColumn(
            "_reason",
            F.when(~(F.col("_object") if "_object" in docs.columns else is_json_object("_source")), F.lit(NOT_AN_OBJECT))
            .when(F.col("_id").isNull() | F.col("_routing").isNull(), F.lit(MISSING_ID)),
        ).withColumn("_field", F.lit(None).cast("string")).drop(*PARSED)
    ok = F.col("_reason").isNull()
    return (
        checked.withColumn("_status", F.when(ok, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)))
        .withColumn("_shard", hash_bucket(F.col("_routing"), spec.shards))
        .withColumn("_hash", F.xxhash64("_id", "_source"))
        .withColumn("_bytes", F.octet_length("_source").cast("bigint"))
        .withColumn("_slice", files.key_slice("_id"))
    )


def _stage_root(dest: str, index: str, gen: str) -> str:
    return f"{layout.index_root(dest, index)}/ingest/gen={gen}"


def rejects_dir(dest: str, index: str, gen: str) -> str:
    return f"{_stage_root(dest, index, gen)}/_status={REJECTED}"


def accepted_dir(dest: str, index: str, gen: str) -> str:
    return f"{_stage_root(dest, index, gen)}/_status={ACCEPTED}"


def latest_dir(dest: str, index: str, gen: str) -> str:
    """The newest change of each key of a delta upsert, until it is committed."""
    return f"{_stage_root(dest, index, gen)}/latest"


def ingest(spark: SparkSession, docs: DataFrame, dest: str, spec: IndexSpec, gen: str) -> dict:
    """Job 1: one pass over the input; returns the observed ingest metrics (A2)."""
    prepared = prepare(docs, spec)
    obs = Observation(f"ingest_{gen}")
    observed = prepared.observe(
        obs,
        F.count(F.lit(1)).alias("scanned"),
        F.count(F.when(F.col("_status") == REJECTED, 1)).alias("rejects"),
        F.coalesce(F.sum(F.when(F.col("_status") == ACCEPTED, F.col("_bytes"))), F.lit(0)).alias("bytes"),
    )
    observed.write.mode("errorifexists").partitionBy("_status").parquet(_stage_root(dest, spec.index, gen))
    return dict(obs.get)


# --------------------------------------------------------------- publish ----

def partition_plan(sizes: dict[int, int], n: int, target_bytes: int) -> tuple[list[int], list[int], int]:
    """Tasks per shard (``k``), first task id per shard, and total tasks."""
    ks = [max(1, math.ceil(sizes.get(s, 0) / target_bytes)) for s in range(n)]
    offsets, acc = [], 0
    for k in ks:
        offsets.append(acc)
        acc += k
    return ks, offsets, acc


def _part_id(ks: list[int], offsets: list[int], scatter: Column) -> Column:
    """Task id = first task of the shard + its share of the key slices, in
    order, so that each file holds few of them.  Rows of one id share a slice
    unless ``scatter`` is true for them; those are spread by their position in
    the staged scan instead."""
    shard1 = F.col("_shard") + 1
    k = F.element_at(F.array(*[F.lit(x) for x in ks]), shard1).cast("bigint")
    off = F.element_at(F.array(*[F.lit(x) for x in offsets]), shard1)
    by_slice = F.floor(F.col("_slice") * k / files.SLICES)
    return (off + F.when(scatter, F.pmod(F.monotonically_increasing_id(), k)).otherwise(by_slice)).cast("int")


# Hot ids are looked for only when some shard gets more than one write task
# (otherwise each shard is one task anyway).  A bounded row sample of the
# staged (shard, id) hashes is counted; an id is hot when its sampled rows
# stand for at least half a write task's worth of data.
HOT_SAMPLE_ROWS = 2_000_000
HOT_MIN_HITS = 50


def _id_key() -> Column:
    return F.xxhash64(F.col("_shard"), F.col("_id"))


def hot_ids(staged: DataFrame, accepted: int, total_bytes: int, target_bytes: int,
            sample_rows: int = HOT_SAMPLE_ROWS) -> list[int]:
    """Hashes of (shard, id) pairs that hold a large share of the rows.

    The sample (at most ``sample_rows`` rows, seeded, so a re-run draws the
    same rows) only plans the layout; no row is dropped.  At most
    ``sample_rows / HOT_MIN_HITS`` hashes can qualify, so the list is bounded.
    A cold id that collides with a hot hash merely takes the two-step path."""
    if accepted <= 0:
        return []
    frac = min(1.0, sample_rows / accepted)
    share = min(0.01, target_bytes / (2.0 * max(total_bytes, 1)))
    need = max(HOT_MIN_HITS, int(math.ceil(share * accepted * frac)))
    keys = staged.select(_id_key().alias("h"))
    if frac < 1.0:
        keys = keys.sample(fraction=frac, seed=17)
    rows = keys.groupBy("h").count().where(F.col("count") >= need).select("h").collect()
    return sorted(r.h for r in rows)


def _flag_hot(staged: DataFrame, hot: list[int]) -> DataFrame:
    """``staged`` with ``_hot``; the hashes are at most ``HOT_SAMPLE_ROWS / HOT_MIN_HITS``, as a small table."""
    if not hot:
        return staged.withColumn("_hot", F.lit(False))
    keys = staged.sparkSession.createDataFrame([(h, True) for h in hot], "_key bigint, _hot boolean")
    flagged = staged.withColumn("_key", _id_key()).join(F.broadcast(keys), "_key", "left").drop("_key")
    return flagged.withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def _find_hot(staged: DataFrame, spec: IndexSpec, sizes: dict[int, int], accepted: int) -> list[int]:
    ks, _, _ = partition_plan(sizes, spec.shards, spec.target_file_bytes)
    if not spec.dedup or max(ks) <= 1:
        return []
    return hot_ids(staged, accepted, sum(sizes.values()), spec.target_file_bytes)


def _dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rank-1 per key: highest version, then later arrival, then greater source.
    ``_copies`` is the number of rows that it stands for."""
    order = [F.desc("_seq")] + ([F.desc("_arrival")] if "_arrival" in df.columns else []) + [F.desc("_source")]
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    copies = F.sum("_copies") if "_copies" in df.columns else F.count(F.lit(1))
    ranked = df.withColumns({"_rn": F.row_number().over(w), "_copies": copies.over(whole)})
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def shard_layout(staged: DataFrame, spec: IndexSpec, sizes: dict[int, int],
                 hot: list[int] | None = None) -> DataFrame:
    """The single shuffle: shard slices by ``repartitionById``, then last write
    wins per (shard, id) on the same exchange.  Output is sorted by
    (shard, id) within each task, which is also the writer's required order.
    ``_copies`` counts the rows that each row stands for.

    Hot ids (``hot``: hashes of (shard, id)) are scattered over their shard's tasks, reduced to one
    row per task there, and the few survivors are reduced once more in a
    small second step; without dedup every row is scattered."""
    n = spec.shards
    ks, offsets, total = partition_plan(sizes, n, spec.target_file_bytes)
    if "_slice" not in staged.columns:
        staged = staged.withColumn("_slice", files.key_slice("_id"))
    parted = (
        _flag_hot(staged.withColumn("_shard", checked_shard(F.col("_shard"), n)), hot or [])
        .withColumn("_part", _part_id(ks, offsets, F.col("_hot") if spec.dedup else F.lit(True)))
        .repartitionById(total, F.col("_part"))
    )
    if not spec.dedup:
        out = parted.sortWithinPartitions("_shard", "_part", "_id").withColumn("_copies", F.lit(1).cast("bigint"))
        return out.drop("_part", "_arrival", "_hot")
    if not hot:
        return _dedup(parted.drop("_hot"), ["_shard", "_part", "_id"]).drop("_part", "_arrival")
    cold = _dedup(parted.where(~F.col("_hot")), ["_shard", "_part", "_id"])
    hot_final = _dedup(_dedup(parted.where("_hot"), ["_shard", "_part", "_id"]), ["_shard", "_id"])
    return cold.unionByName(hot_final).drop("_part", "_arrival", "_hot")


def _data_columns(df: DataFrame) -> list[str]:
    drop = {"_status", "_reason", "_field", "gen"}
    return [c for c in df.columns if c not in drop]


def publish(
    spark: SparkSession,
    staged: DataFrame,
    dest: str,
    spec: IndexSpec,
    gen: str,
    sizes: dict[int, int],
    hot: list[int] | None = None,
) -> dict:
    """Job 3: write the shard files of generation ``gen``; returns observed
    totals and the schema of the written rows (``data_schema``)."""
    laid = shard_layout(staged.select(*_data_columns(staged)), spec, sizes, hot)
    fields = [f for f in laid.schema.fields if f.name not in ("_shard", "_copies")] + [T.StructField("_shard", T.IntegerType())]
    data_schema = T.StructType(fields).json()
    return {**_write_shards(laid, dest, spec, gen, sum(sizes.values())), "data_schema": data_schema}


def _write_shards(laid: DataFrame, dest: str, spec: IndexSpec, gen: str, size: int) -> dict:
    """Write laid-out rows as generation ``gen``; returns what was written and
    how many rows (``copies``) it stands for.  Each row group gets a Bloom
    filter of its ids."""
    obs = Observation(f"publish_{gen}")
    observed = laid.observe(
        obs,
        F.count(F.lit(1)).alias("docs"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.bit_xor("_hash"), F.lit(0)).alias("checksum"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("copies"),
    )
    ids = max(1_000, min(1_000_000, min(size, spec.target_file_bytes) // BYTES_AN_ID))
    writer = observed.drop("_copies").write.mode("errorifexists").partitionBy("_shard")
    writer = writer.option("parquet.bloom.filter.enabled#_id", "true").option("parquet.bloom.filter.expected.ndv#_id", str(ids))
    writer.parquet(layout.data_path(dest, spec.index, gen))
    return dict(obs.get)


def shard_file_bytes(written: DataFrame) -> DataFrame:
    """A4, physical: bytes on disk per shard (each file counted once)."""
    per_file = written.select(
        F.col("_shard").cast("int").alias("shard"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size")
    ).distinct()
    return per_file.groupBy("shard").agg(F.sum("size").cast("bigint").alias("file_bytes"))


def _manifest_rows(
    spark: SparkSession, dest: str, spec: IndexSpec, gen: str, shards: list[int] | None, written_docs: int = 1
) -> list[dict]:
    """Job 4: n manifest rows for the shards written in ``gen``."""
    rows: dict = {}
    if written_docs > 0:
        table = files.write_file_table(spark, dest, spec.index, gen)
        rows = {r.shard: r.asDict() for r in files.shard_rows(table).collect()}  # <= n rows
    out = []
    for s in shards if shards is not None else range(spec.shards):
        r = rows.get(s, {"docs": 0, "bytes": 0, "min_id": None, "max_id": None, "checksum": 0, "files": 0, "file_bytes": 0})
        out.append(
            {
                "index": spec.index,
                "snapshot": layout.snapshot_name(spec.index),
                "generation": gen,
                "shard": s,
                "docs": int(r["docs"]),
                "bytes": int(r["bytes"] or 0),
                "min_id": r["min_id"],
                "max_id": r["max_id"],
                "checksum": int(r["checksum"] or 0),
                "files": int(r["files"]),
                "file_bytes": int(r["file_bytes"] or 0),
                "data_gen": gen,
                "base_docs": int(r["docs"]),
                "delta_gens": "",
                "delta_docs": 0,
                "mask_gen": None,
                "mask_bytes": 0,
            }
        )
    return out


def _write_json_rows(spark: SparkSession, folder: str, rows: list[dict]) -> None:
    """Write a few driver-side rows (n manifest rows, one commit row) as one
    JSON-lines file: written under a hidden name, then renamed into place, so
    readers never see a partial file.  Fails if the file already exists."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(f"{folder}/part-00000.json")
    tmp = jvm.org.apache.hadoop.fs.Path(f"{folder}/_tmp-part-00000.json")
    fs = final.getFileSystem(conf)
    if fs.exists(final):
        raise FileExistsError(str(final))
    out = fs.create(tmp, False)
    try:
        data = "".join(json.dumps(r, separators=(",", ":")) + "\n" for r in rows).encode("utf-8")
        out.write(bytearray(data))
    finally:
        out.close()
    if not fs.rename(tmp, final):
        raise OSError(f"could not move {tmp} to {final}")


def _write_manifest(spark: SparkSession, dest: str, index: str, gen: str, rows: list[dict]) -> None:
    _write_json_rows(spark, layout.manifest_path(dest, index, gen), rows)


def _commit(spark: SparkSession, dest: str, spec: IndexSpec, gen: str, parent: str | None,
            rows: list[dict], rejects: int, data_schema: str, tag: str | None = None, dedup: bool | None = None,
            batch: tuple[str, int] | None = None) -> dict:
    """The commit row, under the next number of the index's log.  The order
    of commits is their number, not the time at which a build began, so a
    rebuild that ends last is what readers see.  An update built on ``parent``
    commits only if that is the commit right before it: whoever takes the
    number first decides, and the other one is refused."""

    def row(newest: dict | None) -> dict:
        if parent is not None and (newest is None or newest["generation"] != parent):
            raise ConcurrentUpdateError(
                f"{spec.index}: built on {parent}, but {newest and newest['generation']} was committed meanwhile; retry the update"
            )
        batches = dict((newest or {}).get("batches") or {})
        if batch is not None:
            batches[batch[0]] = batch[1]
        return {
            "dedup": spec.dedup if dedup is None else dedup,
            "index": spec.index,
            "snapshot": layout.snapshot_name(spec.index),
            "type": spec.type_name,
            "generation": gen,
            "parent": parent,
            "shards": spec.shards,
            "docs": sum(r["docs"] for r in rows),
            "bytes": sum(r["bytes"] for r in rows),
            "checksum": _xor([r["checksum"] for r in rows]),
            "rejects": rejects,
            "data_schema": data_schema,
            "created": _dt.datetime.now(_dt.timezone.utc).isoformat(),
            "tag": tag,
            "batches": batches,
        }

    return commits.append(spark, layout.snapshots_root(dest, spec.index), row)


def _xor(values) -> int:
    acc = 0
    for v in values:
        acc ^= v & 0xFFFFFFFFFFFFFFFF
    return acc - (1 << 64) if acc >= (1 << 63) else acc


def _check(rows: list[dict], observed: dict, n: int, shards: list[int] | None, accepted: int | None = None) -> None:
    """Commit only a complete, consistent generation: the files hold what
    the job wrote, and each of the ``accepted`` rows that went in is either
    stored or superseded by the stored row that counts it."""
    want = list(shards) if shards is not None else list(range(n))
    have = [r["shard"] for r in rows]
    if sorted(have) != sorted(want) or len(set(have)) != len(have):
        raise RuntimeError(f"manifest shards {have} do not match expected {want}")
    docs = sum(r["docs"] for r in rows)
    byts = sum(r["bytes"] for r in rows)
    chk = _xor([r["checksum"] for r in rows])
    if (docs, byts, chk) != (observed["docs"], observed["bytes"], _xor([observed["checksum"]])):
        raise RuntimeError(
            f"written files disagree with the write job: files say docs={docs} bytes={byts} "
            f"checksum={chk}, job observed {observed}"
        )
    if accepted is not None and observed["copies"] != accepted:
        raise RuntimeError(
            f"{accepted} rows went in, but {observed['docs']} are stored and {observed['copies'] - observed['docs']} superseded"
        )


def build_index(spark: SparkSession, docs: DataFrame, dest: str, spec: IndexSpec) -> BuildResult:
    """Build generation ``gen`` of ``spec.index`` under ``dest`` and commit it."""
    gen = layout.new_generation()
    ingest_metrics = ingest(spark, docs, dest, spec, gen)
    staged = spark.read.parquet(accepted_dir(dest, spec.index, gen)) if ingest_metrics["scanned"] > ingest_metrics["rejects"] else None
    if staged is not None:
        sizes = {r["_shard"]: r["b"] for r in staged.groupBy("_shard").agg(F.sum("_bytes").alias("b")).collect()}
        hot = _find_hot(staged, spec, sizes, ingest_metrics["scanned"] - ingest_metrics["rejects"])
        observed = publish(spark, staged, dest, spec, gen, sizes, hot)
        data_schema = observed.pop("data_schema")
    else:
        observed = {"docs": 0, "bytes": 0, "checksum": 0, "copies": 0}
        data_schema = ""
    rows = _manifest_rows(spark, dest, spec, gen, None, observed["docs"])
    _check(rows, observed, spec.shards, None, ingest_metrics["scanned"] - ingest_metrics["rejects"])
    _write_manifest(spark, dest, spec.index, gen, rows)
    snap = _commit(spark, dest, spec, gen, None, rows, int(ingest_metrics["rejects"]), data_schema)
    if not spec.keep_staging:
        remove_staging(spark, dest, spec.index, gen)
    return BuildResult(dest, spec.index, gen, spec.shards, {**ingest_metrics, **observed, "snapshot": snap})


# ------------------------------------------------------------- read side ----

def list_snapshots(spark: SparkSession, dest: str, index: str) -> DataFrame:
    """Committed generations of an index (one row each)."""
    rows = commits.rows(spark, layout.snapshots_root(dest, index))
    return spark.createDataFrame([tuple(r.get(f) for f in SNAPSHOT_SCHEMA.names) for r in rows], SNAPSHOT_SCHEMA)


def newest_snapshot(spark: SparkSession, dest: str, index: str) -> dict | None:
    """The row committed last, or None if nothing is committed yet."""
    return commits.newest(spark, layout.snapshots_root(dest, index))


def latest_snapshot(spark: SparkSession, dest: str, index: str, generation: str | None = None) -> dict:
    if generation is None:
        snap = newest_snapshot(spark, dest, index)
    else:
        found = [r for r in commits.rows(spark, layout.snapshots_root(dest, index)) if r["generation"] == generation]
        snap = found[-1] if found else None
    if snap is None:
        raise FileNotFoundError(f"no committed snapshot of {index!r} under {dest!r}")
    return snap


def read_manifest(spark: SparkSession, dest: str, index: str, generation: str | None = None) -> DataFrame:
    gen = generation or latest_snapshot(spark, dest, index)["generation"]
    return spark.read.schema(MANIFEST_SCHEMA).json(layout.manifest_path(dest, index, gen))


path_exists = commits.exists


def read_rejects(spark: SparkSession, dest: str, index: str, generation: str) -> DataFrame:
    path = rejects_dir(dest, index, generation)
    if not path_exists(spark, path):  # nothing was refused
        return spark.createDataFrame([], "_id string, _source string, reason string, field string")
    df = spark.read.parquet(path)
    return df.select("_id", "_source", F.col("_reason").alias("reason"), F.col("_field").alias("field"))


def _layers(row) -> tuple[int, list[str]]:
    base_docs = row["base_docs"] if row["base_docs"] is not None else row["docs"]
    deltas = [g for g in (row["delta_gens"] or "").split(",") if g]
    return base_docs, deltas


# Columns of a document frame when nothing has been written yet.
EMPTY_DOCS_SCHEMA = "_id string, _routing string, _seq bigint, _source string, _hash bigint, _bytes bigint, _slice int, _shard int"
# Bookkeeping columns kept in delta files only (what each delta row replaced, and where that is stored).
DELTA_ONLY = {"_replaces": "boolean", "_old_seq": "bigint", "_old_hash": "bigint", "_old_bytes": "bigint", "_old_file": "string", "_old_row": "bigint"}

# Most bytes of change keys that are broadcast when the rows they replace are looked up.
BROADCAST_KEY_BYTES = 64 << 20
KEY_OVERHEAD = 48  # bytes of a key in a broadcast table besides its id
BYTES_AN_ID = 64  # of source text, at least, for each id that a Bloom filter is sized for


def _gens(row) -> list[str]:
    """The generations whose files of the shard a manifest row names: base, then layers."""
    base_docs, deltas = _layers(row)
    return ([row["data_gen"]] if base_docs > 0 else []) + deltas


def _shard_folders(dest: str, index: str, row) -> list[str]:
    return [layout.shard_path(dest, index, g, row["shard"]) for g in _gens(row)]


def _mask_groups(man: list, limit: int) -> list[tuple[list, bool]]:
    """The manifest rows in groups to be read by one scan each, and whether a
    group has masks: all shards without masks, then groups whose bitmaps fit ``limit``."""
    plain = [r for r in man if not r["mask_bytes"]]
    groups, size = [], 0
    for r in (r for r in man if r["mask_bytes"]):
        if not groups or size + r["mask_bytes"] > limit:
            groups.append([])
            size = 0
        groups[-1].append(r)
        size += r["mask_bytes"]
    return ([(plain, False)] if plain else []) + [(g, True) for g in groups]


def _scan(spark: SparkSession, dest: str, index: str, schema: T.StructType | None, man: list, where: Column | None = None,
          locate: bool = False) -> list[DataFrame]:
    """The stored rows that the manifest rows ``man`` name, with ``_live`` (and
    located, if asked for): one scan for each group of :func:`_mask_groups`, filtered by ``where`` first."""
    out = []
    for rows, has_masks in _mask_groups(man, files.BROADCAST_MASK_BYTES):
        paths = [p for r in rows for p in _shard_folders(dest, index, r)]
        if not paths:
            continue
        reader = spark.read.option("basePath", layout.data_root(dest, index))
        if schema is not None:  # declared schema: no footer reads to infer it; columns that a layer lacks are NULL
            reader = reader.schema(T.StructType([f for f in schema.fields if f.name != "_shard"]))
        df = reader.parquet(*paths)
        df = files.located(df) if has_masks or locate else df
        if where is not None:
            df = df.where(where)
        if has_masks:
            df = files.masked(df, files.read_masks(spark, dest, index, [(r["mask_gen"], r["shard"]) for r in rows]))
        else:
            df = df.withColumn("_live", F.lit(True))
        out.append(df)
    return out


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def _schema(snap: dict) -> T.StructType | None:
    return T.StructType.fromJson(json.loads(snap["data_schema"])) if snap["data_schema"] else None


def restore_snapshot(spark: SparkSession, dest: str, index: str, generation: str | None = None, without: list[int] = ()) -> DataFrame:
    """The documents of the newest committed generation (or ``generation``), of all shards but ``without``.

    Only generations with a commit are visible.  Each shard is read from
    the generation that last wrote it (upserts carry untouched shards over),
    and ``_shard`` stays a partition column, so shard filters prune files.
    Delta layers (``upsert(mode="delta")``) are further files of a shard; the
    rows that they replace are masked by a bitmap for each file.  So reading
    is a scan whatever was updated: nothing is shuffled, sorted or ranked, and
    what is broadcast is bounded (``files.BROADCAST_MASK_BYTES`` a scan).
    """
    snap = latest_snapshot(spark, dest, index, generation)
    man = read_manifest(spark, dest, index, snap["generation"]).collect()  # n rows
    return _documents(spark, dest, index, snap, [r for r in man if r["shard"] not in without])


def _documents(spark: SparkSession, dest: str, index: str, snap: dict, man: list) -> DataFrame:
    """The documents of the shards that ``man``, rows of the manifest of ``snap``, names."""
    schema = _schema(snap)
    parts = _scan(spark, dest, index, schema, man)
    if not parts:
        return spark.createDataFrame([], schema if schema is not None else EMPTY_DOCS_SCHEMA)
    names = [f.name for f in schema.fields if f.name != "_shard"] if schema is not None else [c for c in parts[0].columns if c not in ("_file", "_row", "_live", "gen", "_shard", *DELTA_ONLY)]
    return _union([p.where("_live").select(*names, "_shard") for p in parts])


# ---------------------------------------------------------------- upsert ----

# upsert mode "auto": a delta layer while the change is small next to the
# shards it touches and their existing layers are still thin and few; else rewrite.
AUTO_DELTA_MAX_CHANGE = 0.10
AUTO_DELTA_MAX_LAYERED = 0.25
AUTO_DELTA_MAX_LAYERS = 8


def choose_mode(base_man: dict, change_sizes: dict[int, int]) -> str:
    touched = list(change_sizes)
    shard_bytes = sum(int(base_man[s]["bytes"] or 0) for s in touched)
    docs = sum(int(base_man[s]["docs"] or 0) for s in touched)
    layered = sum(int(base_man[s]["delta_docs"] or 0) for s in touched)
    small = sum(change_sizes.values()) <= AUTO_DELTA_MAX_CHANGE * shard_bytes
    thin = layered <= AUTO_DELTA_MAX_LAYERED * max(docs, 1)
    few = all(len(_layers(base_man[s])[1]) < AUTO_DELTA_MAX_LAYERS for s in touched)
    fits = all(int(base_man[s]["docs"] or 0) <= 8 * files.BROADCAST_MASK_BYTES for s in touched)  # a bit a row
    return "delta" if small and thin and few and fits else "rewrite"


def upsert(spark: SparkSession, changes: DataFrame, dest: str, spec: IndexSpec, tag: str | None = None,
           mode: str = "auto", batch: tuple[str, int] | None = None, parent: str | None = None) -> BuildResult:
    """Add or replace documents in the current generation.

    ``mode="rewrite"``: only shards that receive a change are rewritten (base
    rows of those shards + changes, last write wins); the others are carried
    over by reference in the new manifest.

    ``mode="auto"`` (default) picks delta for a change that is small next to
    the shards it touches (and while their layers are thin), rewrite otherwise;
    a rewrite also folds the touched shards' layers.

    ``mode="delta"``: nothing is rewritten.  The winning changes (version at
    least the stored one; a tie goes to the later write) are written as a
    delta layer of the touched shards, the rows that they replace are masked
    where they are stored, and the manifest is updated incrementally from
    them.  They are found by a join on the change keys that reads only key
    columns, of the files whose key slices the change has.  Cost follows the
    size of the change, not of the shards.  ``compact_index`` folds the
    layers back into one base.

    All modes give the same rows and the same counts.  An index built with
    ``dedup=False`` keeps every copy: changes are added and replace nothing
    (the spec must say the same as the index).  Columns are the union of
    the index's and the changes', NULL where a row has none; a column whose
    type differs is an error before anything is written.  ``batch`` is the
    name of a streaming query and the number of its batch, kept in the commit.
    ``parent`` is the generation that the changes are meant for: if it is not
    the newest one when they are committed, they are refused.
    """
    if mode not in ("auto", "rewrite", "delta"):
        raise ValueError(f"mode must be 'auto', 'rewrite' or 'delta', got {mode!r}")
    base_snap = latest_snapshot(spark, dest, spec.index, parent)
    base_man = {r.shard: r.asDict() for r in read_manifest(spark, dest, spec.index, base_snap["generation"]).collect()}
    if base_snap["shards"] != spec.shards:
        raise ValueError(f"index has {base_snap['shards']} shards, spec says {spec.shards}")
    if base_snap["dedup"] is not None and base_snap["dedup"] != spec.dedup:
        raise ValueError(f"index was built with dedup={base_snap['dedup']}, spec says {spec.dedup}")
    union_fields(base_snap["data_schema"], prepare(changes, spec).schema)
    gen = layout.new_generation()
    ingest_metrics = ingest(spark, changes, dest, spec, gen)
    if ingest_metrics["scanned"] == ingest_metrics["rejects"]:
        touched: list[int] = []
    else:
        staged_changes = spark.read.parquet(accepted_dir(dest, spec.index, gen))
        change_sizes = {
            r["_shard"]: r["b"]
            for r in staged_changes.groupBy("_shard").agg(F.sum("_bytes").alias("b")).collect()
        }
        touched = sorted(change_sizes)
    if touched and mode == "auto":
        mode = choose_mode(base_man, change_sizes)
    if touched and mode == "delta":
        return _upsert_delta(spark, staged_changes, dest, spec, gen, base_snap, base_man, change_sizes,
                             ingest_metrics, tag, batch)
    if touched:
        base = _documents(spark, dest, spec.index, base_snap, [base_man[s] for s in touched])
        base = base.withColumn("_shard", F.col("_shard").cast("int"))
        merged = base.withColumn("_arrival", F.lit(0)).unionByName(
            staged_changes.select(*_data_columns(staged_changes), F.lit(1).alias("_arrival")), allowMissingColumns=True
        )
        sizes = {s: change_sizes.get(s, 0) + base_man[s]["bytes"] for s in touched}
        # base rows are unique per id, so only the changes can bring a hot id
        hot = _find_hot(staged_changes, spec, change_sizes, ingest_metrics["scanned"] - ingest_metrics["rejects"])
        observed = publish(spark, merged, dest, spec, gen, sizes, hot)
        data_schema = observed.pop("data_schema")
    else:
        observed = {"docs": 0, "bytes": 0, "checksum": 0, "copies": 0}
        data_schema = base_snap["data_schema"]
    new_rows = {r["shard"]: r for r in _manifest_rows(spark, dest, spec, gen, touched, observed["docs"])} if touched else {}
    accepted = ingest_metrics["scanned"] - ingest_metrics["rejects"]
    _check(list(new_rows.values()), observed, spec.shards, touched, accepted + sum(base_man[s]["docs"] for s in touched))
    rows = []
    for s in range(spec.shards):
        if s in new_rows:
            rows.append(new_rows[s])
        else:
            carried = dict(base_man[s])
            carried["generation"] = gen
            rows.append(carried)
    _write_manifest(spark, dest, spec.index, gen, rows)
    snap = _commit(spark, dest, spec, gen, base_snap["generation"], rows, int(ingest_metrics["rejects"]),
                   data_schema or base_snap["data_schema"], tag, batch=batch)
    if not spec.keep_staging:
        remove_staging(spark, dest, spec.index, gen)
    return BuildResult(dest, spec.index, gen, spec.shards, {**ingest_metrics, **observed, "snapshot": snap})


def union_fields(data_schema: str, changes: T.StructType) -> str:
    """The index's columns, then those that only the changes have, ``_shard`` last (JSON)."""
    base = T.StructType.fromJson(json.loads(data_schema)).fields if data_schema else []
    fields = {f.name: f for f in base if f.name != "_shard"}
    for f in changes.fields:
        if f.name in ("_shard", "_status", "_reason", "_field", "gen", *DELTA_ONLY):
            continue
        old = fields.setdefault(f.name, f)
        if old.dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name!r} is {old.dataType.simpleString()} in the index, {f.dataType.simpleString()} in the changes")
    return T.StructType([*fields.values(), T.StructField("_shard", T.IntegerType())]).json()


def _latest_changes(spark, staged_changes, dest, spec, gen, accepted: int) -> tuple[DataFrame, dict]:
    """The newest change of each key, written once as it is looked up and laid out; with the count, bytes and slices of the keys."""
    obs = Observation(f"changes_{gen}")
    changes = _dedup(staged_changes.select(*_data_columns(staged_changes)), ["_shard", "_id"])
    path = latest_dir(dest, spec.index, gen)
    changes.observe(
        obs,
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("copies"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(F.octet_length("_id")), F.lit(0)).alias("id_bytes"),
        F.collect_set("_slice").alias("slices"),  # files.SLICES at most
    ).drop("_copies").write.mode("errorifexists").parquet(path)
    seen = obs.get
    if seen["copies"] != accepted:
        raise RuntimeError(f"{accepted} changes were accepted, but those kept stand for {seen['copies']}")
    return spark.read.parquet(path), seen


def _stored_rows(spark, latest: DataFrame, seen: dict, dest, spec, base_snap, base_man, touched) -> DataFrame | None:
    """What is stored, and where, under the keys of the changes: only files of
    touched shards whose key slices the changes have are read, and of them only key columns."""
    keys = latest.select(F.col("_shard").alias("_k_shard"), F.col("_id").alias("_k_id"))
    if seen["id_bytes"] + KEY_OVERHEAD * seen["keys"] <= BROADCAST_KEY_BYTES:  # checked bound before broadcasting
        keys = F.broadcast(keys)
    parts = _scan(spark, dest, spec.index, _schema(base_snap), [base_man[s] for s in touched], where=files.in_slices(list(seen["slices"])), locate=True)
    on = (F.col("_shard") == F.col("_k_shard")) & (F.col("_id") == F.col("_k_id"))
    return _union([p.where("_live").select(
        F.col("_shard").cast("int").alias("_shard"), "_id", F.col("_seq").alias("_old_seq"), F.col("_hash").alias("_old_hash"),
        F.col("_bytes").alias("_old_bytes"), F.col("_file").alias("_old_file"), F.col("_row").alias("_old_row"),
    ).join(keys, on, "left_semi") for p in parts])


def _delta_winners(spark, staged_changes, dest, spec, gen, base_snap, base_man, touched, accepted: int) -> DataFrame:
    """The changes that enter the layer, with what each replaces; without dedup, all of them, replacing nothing."""
    if not spec.dedup:
        changes = staged_changes.select(*_data_columns(staged_changes))
        return changes.withColumns({c: F.lit(None).cast(t) for c, t in DELTA_ONLY.items()})
    latest, seen = _latest_changes(spark, staged_changes, dest, spec, gen, accepted)
    existing = _stored_rows(spark, latest, seen, dest, spec, base_snap, base_man, touched)
    if existing is None:
        return latest.withColumns({c: F.lit(None).cast(t) for c, t in DELTA_ONLY.items()})
    # a stored row without a version is lower than any version, as in a rewrite
    return latest.join(existing.withColumn("_replaces", F.lit(True)), ["_shard", "_id"], "left").where(
        F.col("_old_seq").isNull() | (F.col("_seq") >= F.col("_old_seq"))
    )


def _upsert_delta(spark, staged_changes, dest, spec, gen, base_snap, base_man, change_sizes, ingest_metrics, tag, batch):
    touched = sorted(change_sizes)
    winners = _delta_winners(spark, staged_changes, dest, spec, gen, base_snap, base_man, touched,
                             ingest_metrics["scanned"] - ingest_metrics["rejects"])
    laid = shard_layout(winners, spec, change_sizes)
    data_schema = union_fields(base_snap["data_schema"], laid.drop("_copies").schema)
    observed = _write_shards(laid, dest, spec, gen, sum(change_sizes.values()))
    stats: dict = {}
    if observed["docs"] > 0:
        added = files.shard_rows(files.write_file_table(spark, dest, spec.index, gen))
        written = spark.read.parquet(layout.data_path(dest, spec.index, gen))
        replaced = written.where("_replaces").withColumn("_shard", F.col("_shard").cast("int"))
        lost = replaced.groupBy(F.col("_shard").alias("shard")).agg(
            F.count(F.lit(1)).alias("replaced"),
            F.sum("_old_bytes").cast("bigint").alias("replaced_bytes"),
            F.bit_xor("_old_hash").alias("replaced_xor"),
        )
        stats = {r.shard: r.asDict() for r in added.join(F.broadcast(lost), "shard", "left").collect()}  # <= touched shards
        if any(x["replaced"] for x in stats.values()):
            masked = [(base_man[s]["mask_gen"], s) for s in touched if base_man[s]["mask_bytes"] and stats.get(s, {}).get("replaced")]
            before = files.read_masks(spark, dest, spec.index, masked) if masked else None
            files.write_masks(spark, dest, spec.index, gen, replaced.select("_shard", F.col("_old_file").alias("_file"), F.col("_old_row").alias("_row")), before)
    if (sum(x["docs"] for x in stats.values()), sum(x["bytes"] for x in stats.values()),
            _xor([x["checksum"] for x in stats.values()])) != (observed["docs"], observed["bytes"], _xor([observed["checksum"]])):
        raise RuntimeError(f"delta files disagree with the write job: {stats} vs {observed}")
    rows = []
    for s in range(spec.shards):
        r = dict(base_man[s])
        r["generation"] = gen
        x = stats.get(s)
        if x:
            base_docs, deltas = _layers(r)
            stored, before = base_docs + int(r["delta_docs"] or 0), int(r["files"])
            r["docs"] = r["docs"] + x["docs"] - (x["replaced"] or 0)
            r["bytes"] = r["bytes"] + x["bytes"] - (x["replaced_bytes"] or 0)
            r["checksum"] = _xor([r["checksum"], x["checksum"], x["replaced_xor"] or 0])
            r["min_id"] = min(v for v in (r["min_id"], x["min_id"]) if v is not None)
            r["max_id"] = max(v for v in (r["max_id"], x["max_id"]) if v is not None)
            r["files"] = int(r["files"]) + int(x["files"])
            r["file_bytes"] = int(r["file_bytes"] or 0) + int(x["file_bytes"] or 0)
            r["base_docs"] = base_docs
            r["delta_gens"] = ",".join(deltas + [gen])
            r["delta_docs"] = int(r["delta_docs"] or 0) + int(x["docs"])
            if x["replaced"]:
                r["mask_gen"] = gen
                r["mask_bytes"] = (r["mask_bytes"] or 0) + files.most_mask_bytes(x["replaced"], stored, before)
        rows.append(r)
    _write_manifest(spark, dest, spec.index, gen, rows)
    snap = _commit(spark, dest, spec, gen, base_snap["generation"], rows, int(ingest_metrics["rejects"]),
                   data_schema, tag, batch=batch)
    if not spec.keep_staging:
        remove_staging(spark, dest, spec.index, gen)
    return BuildResult(dest, spec.index, gen, spec.shards, {**ingest_metrics, **observed, "snapshot": snap})


def plan_compaction(man: list, target_file_bytes: int, masked_share: float = 0.0, small_files: float = 2.0) -> list[int]:
    """The shards that are worth a rewrite: those with layers or masked
    rows (more than ``masked_share`` of what is stored), and those with
    ``small_files`` times as many files as their bytes fill, or more."""
    out = []
    for r in man:
        base_docs, deltas = _layers(r)
        stored = base_docs + int(r["delta_docs"] or 0)
        idle = (stored - r["docs"]) / stored if stored else 0.0
        needed = max(1, math.ceil((r["bytes"] or 0) / target_file_bytes))
        if (deltas and idle >= masked_share) or idle > masked_share or r["files"] >= max(2, small_files * needed):
            out.append(r["shard"])
    return out


def compact_index(spark: SparkSession, dest: str, spec: IndexSpec, shards: list[int] | None = None) -> BuildResult:
    """Rewrite shards of the newest generation into id-sorted files of
    about ``spec.target_file_bytes`` each, as a new generation: those that
    :func:`plan_compaction` picks, or ``shards``.  The others are carried over
    by reference, so what is written follows what is picked; if that is
    nothing, the newest generation stays.  The rows of the base are final:
    nothing is validated, routed or de-duplicated again, and the result must
    have the base's totals, or it is not committed."""
    base_snap = latest_snapshot(spark, dest, spec.index)
    if base_snap["shards"] != spec.shards:
        raise ValueError(f"index has {base_snap['shards']} shards, spec says {spec.shards}")
    man = {r.shard: r.asDict() for r in read_manifest(spark, dest, spec.index, base_snap["generation"]).collect()}  # n rows
    picked = sorted(set(plan_compaction(list(man.values()), spec.target_file_bytes) if shards is None else shards))
    if not set(picked) <= set(man):
        raise ValueError(f"no such shards: {sorted(set(picked) - set(man))}")
    if not picked:
        return BuildResult(dest, spec.index, base_snap["generation"], spec.shards, {"picked": [], "snapshot": base_snap})
    gen = layout.new_generation()
    sizes = {s: man[s]["bytes"] for s in picked}
    base = {"docs": sum(man[s]["docs"] for s in picked), "bytes": sum(sizes.values()), "checksum": _xor([man[s]["checksum"] for s in picked])}
    data_schema = base_snap["data_schema"]
    observed = {"docs": 0, "bytes": 0, "checksum": 0, "copies": 0}
    if base["docs"]:
        docs = _documents(spark, dest, spec.index, base_snap, [man[s] for s in picked])
        docs = docs.withColumn("_shard", F.col("_shard").cast("int"))
        observed = publish(spark, docs, dest, replace(spec, dedup=False), gen, sizes)
        data_schema = observed.pop("data_schema")
    new = {r["shard"]: r for r in _manifest_rows(spark, dest, spec, gen, picked, observed["docs"])}
    _check(list(new.values()), base, spec.shards, picked)
    rows = [new[s] if s in new else {**man[s], "generation": gen} for s in range(spec.shards)]
    _write_manifest(spark, dest, spec.index, gen, rows)
    snap = _commit(spark, dest, spec, gen, base_snap["generation"], rows, 0, data_schema, dedup=base_snap["dedup"])
    return BuildResult(dest, spec.index, gen, spec.shards, {**observed, "picked": picked, "snapshot": snap})


# ---------------------------------------------------------------- verify ----

def verify_files(spark: SparkSession, dest: str, index: str, generation: str | None = None,
                 deep: bool = True, since: str | None = None) -> DataFrame:
    """A6 by file: re-read every data file and compare it with its row of the file table.

    One row per file: ``shard, gen, file, ok, reason, docs, expected_docs`` and
    what of it is in use (``live_docs, live_bytes, live_checksum``).  ``reason``
    is the first that holds of ``missing_file``, ``unknown_file``, ``docs``,
    ``bytes``, ``checksum`` and ``misrouted``.  With ``deep`` the sums are
    recomputed from ``_source`` (a full read), else from the stored per-row
    ``_bytes``/``_hash``.  ``since`` names an older generation, whose files are
    left out: only those that came later are read.  A file that cannot be
    decoded to its end counts with the rows that can."""
    snap = latest_snapshot(spark, dest, index, generation)
    n = snap["shards"]
    man = [r.asDict() for r in read_manifest(spark, dest, index, snap["generation"]).collect()]  # n rows
    old = set()
    if since is not None:
        for r in read_manifest(spark, dest, index, since).collect():
            old |= {(g, r["shard"]) for g in _gens(r)}
    named = sorted({(g, r["shard"]) for r in man for g in _gens(r)} - old)
    there = {x for x in named if path_exists(spark, layout.shard_path(dest, index, *x))}
    empty = "shard int, gen string, file string, docs_read bigint, bytes_read bigint, checksum_read bigint, misrouted bigint, live_docs bigint, live_bytes bigint, live_checksum bigint"
    # deep: recompute from the document text; quick: trust the stored per-row fingerprints and read only the small columns
    size = F.octet_length("_source") if deep else F.col("_bytes")
    fingerprint = F.xxhash64("_id", "_source") if deep else F.col("_hash")
    lenient = spark.read.option("ignoreCorruptFiles", "true").option("basePath", layout.data_root(dest, index))
    schema = _schema(snap)
    if schema is not None:
        lenient = lenient.schema(T.StructType([f for f in schema.fields if f.name != "_shard"]))
    read = None
    for rows, has_masks in _mask_groups(man, files.BROADCAST_MASK_BYTES):
        paths = [layout.shard_path(dest, index, g, r["shard"]) for r in rows for g in _gens(r) if (g, r["shard"]) in there]
        if not paths:
            continue
        df = files.located(lenient.parquet(*paths))
        df = files.masked(df, files.read_masks(spark, dest, index, [(r["mask_gen"], r["shard"]) for r in rows])) if has_masks else df.withColumn("_live", F.lit(True))
        df = df.groupBy(F.col("_shard").cast("int").alias("shard"), "gen", F.col("_file").alias("file")).agg(
            F.count(F.lit(1)).alias("docs_read"),
            F.sum(size).cast("bigint").alias("bytes_read"),
            F.bit_xor(fingerprint).alias("checksum_read"),
            F.sum(F.when(hash_bucket(F.col("_routing"), n) != F.col("_shard"), 1).otherwise(0)).alias("misrouted"),
            F.count(F.when(F.col("_live"), 1)).alias("live_docs"),
            F.sum(F.when(F.col("_live"), size)).cast("bigint").alias("live_bytes"),
            F.bit_xor(F.when(F.col("_live"), fingerprint)).alias("live_checksum"),
        )
        read = df if read is None else read.unionByName(df)
    read = spark.createDataFrame([], empty) if read is None else read
    pairs = spark.createDataFrame(named, "gen string, shard int")  # a row for each folder
    if named:
        known = files.read_file_table(spark, dest, index, sorted({g for g, _ in named})).join(F.broadcast(pairs), ["gen", "shard"], "left_semi")
    else:
        known = spark.createDataFrame([], files.FILES_SCHEMA + ", gen string")
    both = known.join(read, ["shard", "gen", "file"], "full")  # two tables of a row for each file
    reason = F.when(F.col("docs_read").isNull(), "missing_file").when(F.col("docs").isNull(), "unknown_file")
    for name in ("docs", "bytes", "checksum"):
        reason = reason.when(F.col(f"{name}_read") != F.col(name), name)
    reason = reason.when(F.col("misrouted") != 0, "misrouted")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return both.select("shard", "gen", "file", reason.isNull().alias("ok"), reason.alias("reason"), F.coalesce("docs_read", F.lit(0)).alias("docs"),
                       F.coalesce("docs", F.lit(0)).alias("expected_docs"), F.coalesce("misrouted", F.lit(0)).alias("misrouted"),
                       none("live_docs"), none("live_bytes"), none("live_checksum"))


def verify_snapshot(spark: SparkSession, dest: str, index: str, generation: str | None = None,
                    deep: bool = True) -> DataFrame:
    """Re-read every shard and compare with its manifest row.

    With ``deep=True`` recomputes count, bytes and checksum from ``_source``
    (a full read: the integrity check); ``deep=False`` uses the stored per-row
    ``_bytes``/``_hash`` and reads only small columns.  Both check that every
    row's routing hashes to the shard it is stored in.  One row per shard:
    ``shard, ok, reason, docs, expected_docs, file, file_reason``; the reason
    is the first that holds of ``missing_folder``, ``docs``, ``bytes``,
    ``checksum`` and ``misrouted``, else that of a file, NULL for a sound
    shard; the file is the first that :func:`verify_files` objects to, those
    that are missing before others.
    """
    snap = latest_snapshot(spark, dest, index, generation)
    man = read_manifest(spark, dest, index, snap["generation"])
    lost = [r["shard"] for r in man.collect() if not all(path_exists(spark, p) for p in _shard_folders(dest, index, r))]
    each = verify_files(spark, dest, index, snap["generation"], deep)
    bad = F.when(~F.col("ok"), F.struct(F.col("reason") != "missing_file", "gen", "file", "reason"))
    actual = each.groupBy("shard").agg(
        F.sum("live_docs").cast("bigint").alias("docs_read"),
        F.sum("live_bytes").cast("bigint").alias("bytes_read"),
        F.bit_xor("live_checksum").alias("checksum_read"),
        F.sum("misrouted").alias("misrouted"),
        F.min(bad).alias("bad"),
    )
    joined = F.broadcast(man).join(actual, "shard", "left")  # manifest: n rows
    reason = F.when(F.col("shard").isin(lost), "missing_folder")
    for name in ("docs", "bytes", "checksum"):
        reason = reason.when(F.coalesce(F.col(f"{name}_read"), F.lit(0)) != F.col(name), name)
    reason = reason.when(F.coalesce(F.col("misrouted"), F.lit(0)) != 0, "misrouted").otherwise(F.col("bad.reason"))
    return joined.select(
        "shard",
        reason.isNull().alias("ok"),
        reason.alias("reason"),
        F.when(F.col("shard").isin(lost), 0).otherwise(F.coalesce("docs_read", F.lit(0))).cast("bigint").alias("docs"),
        F.col("docs").alias("expected_docs"),
        F.col("bad.file").alias("file"),
        F.col("bad.reason").alias("file_reason"),
    )


def remove_staging(spark: SparkSession, dest: str, index: str, generation: str) -> bool:
    """Delete the accepted staging copies of a committed generation (rejects stay)."""
    gone = [delete_path(spark, d(dest, index, generation)) for d in (accepted_dir, latest_dir)]
    return any(gone)


def expire_snapshots(spark: SparkSession, dest: str, index: str, keep: int = 1,
                     older_than: _dt.timedelta = _dt.timedelta(days=7)) -> list[str]:
    """Remove generations that are out of use; returns the folders removed.

    Kept are the newest ``keep`` commits and whatever was begun less than
    ``older_than`` ago: give it more time than any build or read takes.  Of
    the rest, commits go first, then every shard folder that no kept
    manifest names, manifests, rejects, and the staged copies of builds that
    failed.  Nothing is removed while no generation is committed.
    """
    if keep < 1:
        raise ValueError(f"keep must be at least 1, got {keep!r}")
    snaps = commits.rows(spark, layout.snapshots_root(dest, index))[::-1]  # one row a generation
    limit = layout.generation_at(_dt.datetime.now(_dt.timezone.utc) - older_than)
    kept = {r["generation"] for i, r in enumerate(snaps) if i < keep or r["generation"] >= limit}
    if not kept:
        return []
    manifests = spark.read.schema(MANIFEST_SCHEMA).json([layout.manifest_path(dest, index, g) for g in sorted(kept)])
    kept_rows = manifests.collect()  # n rows a kept generation
    named = {p for r in kept_rows for p in _shard_folders(dest, index, r)}
    used = {p.rsplit("/", 1)[0] for p in named}
    root = layout.index_root(dest, index)
    out = commits.forget(spark, layout.snapshots_root(dest, index), {r["commit_no"] for r in snaps if r["generation"] not in kept})
    doomed = []
    for parent in (f"{root}/manifest", f"{root}/ingest"):
        doomed += [f"{parent}/{f}" for f in _folders(spark, parent) if f[len("gen="):] not in kept and f[len("gen="):] < limit]
    in_use = {layout.files_root(dest, index): {g for r in kept_rows for g in _gens(r)}, layout.masks_root(dest, index): {r["mask_gen"] for r in kept_rows}}
    for parent, gens in in_use.items():
        doomed += [f"{parent}/{f}" for f in _folders(spark, parent) if f[len("gen="):] not in kept | gens and f[len("gen="):] < limit]
    for f in _folders(spark, layout.data_root(dest, index)):
        gen, folder = f[len("gen="):], f"{layout.data_root(dest, index)}/{f}"
        if gen in kept or gen >= limit:
            continue
        if folder not in used:
            doomed.append(folder)
        else:
            doomed += [f"{folder}/{s}" for s in _folders(spark, folder, "_shard=") if f"{folder}/{s}" not in named]
    return out + [p for p in doomed if delete_path(spark, p)]


def _folders(spark: SparkSession, parent: str, prefix: str = "gen=") -> list[str]:
    """Names of the folders under ``parent`` that begin with ``prefix``."""
    if not path_exists(spark, parent):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(x for x in names if x.startswith(prefix))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete a folder through the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(p, True))
