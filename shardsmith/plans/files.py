"""What is known of an index's data files, and which of their rows are out of use.

**File table** (W5, A6): one row for each data file of a generation, with its
docs, bytes, checksum, smallest and largest id and key slice.  Files are
sorted by id, so the two ids are those of the first and the last row; all
else is a hash aggregate, and no row is sorted for the manifest.

**Key slices** (W10): ``_slice`` is a hash of the id in ``SLICES`` classes.
A shard's files hold consecutive slices, so the few slices of a change are
pushed to the scan and leave out files by their footers.

**Masks** (S4): an update does not touch the files it replaces rows of.  It
writes the new rows as further files, and for each older file a bitmap of the
rows that they replace.  Reading is one scan, each row tested against its
file's bitmap; no keys are compared, no rows are ranked or shuffled.  A
bitmap takes one bit a row, and shards are read in groups whose bitmaps fit
``BROADCAST_MASK_BYTES``, whatever the size of the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.plans import layout

SLICES = 1 << 16
SLICE_RANGES = 128  # ranges of slices that are pushed to a scan at most
MASK_ROWS = 1 << 15  # rows of one bitmap
MASK_BYTES = MASK_ROWS // 8
BROADCAST_MASK_BYTES = 64 << 20

FILES_SCHEMA = (
    "shard int, file string, docs bigint, bytes bigint, checksum bigint, slice_lo int, slice_hi int, "
    "file_bytes bigint, min_id string, max_id string"
)


def key_slice(id_: Column | str) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(SLICES)).cast("int")


def slice_ranges(slices: list[int], most: int = SLICE_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges that cover the slices: the widest gaps stay out."""
    s = sorted(set(slices))
    gaps = sorted(range(1, len(s)), key=lambda i: s[i - 1] - s[i])[: most - 1]
    cuts = [0, *sorted(g for g in gaps if s[g] - s[g - 1] > 1), len(s)]
    return [(s[a], s[b - 1]) for a, b in zip(cuts, cuts[1:]) if a < b]


def in_slices(slices: list[int]) -> Column | None:
    """Whether ``_slice`` may be one of the slices: a filter that Parquet footers can answer.  None if the slices
    are so many that it would leave little out."""
    ranges = slice_ranges(slices)
    if 2 * sum(b - a + 1 for a, b in ranges) > SLICES:
        return None
    conds = [f"_slice = {a}" if a == b else f"(_slice >= {a} AND _slice <= {b})" for a, b in ranges]
    while len(conds) > 1:  # as one text, as deep as its logarithm
        conds = [f"({a} OR {b})" for a, b in zip(conds[::2], conds[1::2])] + (conds[-1:] if len(conds) % 2 else [])
    return F.expr(conds[0]) if conds else F.lit(False)


# ------------------------------------------------------------ file table ----

def file_stats(written: DataFrame, size: Column | None = None, fingerprint: Column | None = None) -> DataFrame:
    """The sums of a file table (no ids) from the files themselves, in one hash aggregate."""
    return written.groupBy(F.col("_shard").cast("int").alias("shard"), F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.col("_bytes") if size is None else size).cast("bigint").alias("bytes"),
        F.bit_xor(F.col("_hash") if fingerprint is None else fingerprint).alias("checksum"),
        F.min("_slice").alias("slice_lo"),
        F.max("_slice").alias("slice_hi"),
        F.max("_metadata.file_size").cast("bigint").alias("file_bytes"),
    )


def file_ids(written: DataFrame, stats: DataFrame) -> DataFrame:
    """``stats`` with the ids of each file's first and last row, found by row number: two rows of a file are looked at."""
    rows = written.select(F.col("_shard").cast("int").alias("shard"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), "_id")
    ends = rows.join(F.broadcast(stats.select("shard", "file", "docs")), ["shard", "file"])  # a row for each file
    ends = ends.where((F.col("row") == 0) | (F.col("row") == F.col("docs") - 1))
    ids = ends.groupBy("shard", "file").agg(F.array_sort(F.collect_list(F.struct("row", "_id"))).alias("ends"))
    ids = ids.select("shard", "file", F.col("ends")[0]["_id"].alias("min_id"), F.element_at("ends", -1)["_id"].alias("max_id"))
    return stats.join(ids, ["shard", "file"], "left")


def write_file_table(spark: SparkSession, dest: str, index: str, gen: str) -> DataFrame:
    """Read generation ``gen`` back, write its file table and return it."""
    written = spark.read.parquet(layout.data_path(dest, index, gen))
    file_ids(written, file_stats(written)).write.parquet(layout.files_path(dest, index, gen))
    return read_file_table(spark, dest, index, [gen])


def read_file_table(spark: SparkSession, dest: str, index: str, gens: list[str]) -> DataFrame:
    """The file tables of some generations, with ``gen``."""
    parts = [spark.read.schema(FILES_SCHEMA).parquet(layout.files_path(dest, index, g)).withColumn("gen", F.lit(g)) for g in gens]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shard_rows(table: DataFrame) -> DataFrame:
    """Per-shard manifest values from a file table (a row for each file)."""
    return table.groupBy("shard").agg(
        F.sum("docs").cast("bigint").alias("docs"),
        F.sum("bytes").cast("bigint").alias("bytes"),
        F.min("min_id").alias("min_id"),
        F.max("max_id").alias("max_id"),
        F.bit_xor("checksum").alias("checksum"),
        F.count(F.lit(1)).alias("files"),
        F.sum("file_bytes").cast("bigint").alias("file_bytes"),
    )


# ----------------------------------------------------------------- masks ----

def located(rows: DataFrame) -> DataFrame:
    """Scanned rows with the file and the row number they are stored at."""
    return rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _bit(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def masked(rows: DataFrame, masks: DataFrame) -> DataFrame:
    """:func:`located` rows with ``_live``; ``masks`` are known to fit ``BROADCAST_MASK_BYTES``."""
    masks = masks.select(F.col("_shard").alias("__shard"), F.col("file").alias("__file"), F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
    on = (F.col("_shard") == F.col("__shard")) & (F.col("_file") == F.col("__file")) & (F.floor(F.col("_row") / MASK_ROWS) == F.col("__bucket"))
    out = rows.join(F.broadcast(masks), on, "left")
    gone = F.col("__bits").isNotNull() & _bit(F.col("__bits"), F.col("_row") % MASK_ROWS)
    return out.withColumn("_live", ~gone).drop("__shard", "__file", "__bucket", "__bits")


def read_masks(spark: SparkSession, dest: str, index: str, at: list[tuple[str, int]]) -> DataFrame:
    """(_shard, file, bucket, bits) of the (generation, shard) pairs ``at``."""
    paths = [f"{layout.masks_path(dest, index, g)}/_shard={s}" for g, s in at]
    reader = spark.read.schema("file string, bucket bigint, bits binary, gen string, _shard int")
    return reader.option("basePath", layout.masks_root(dest, index)).parquet(*paths).select("_shard", "file", "bucket", "bits")


def write_masks(spark: SparkSession, dest: str, index: str, gen: str, replaced: DataFrame, before: DataFrame | None) -> None:
    """Write the masks of generation ``gen``: the rows ``replaced`` (_shard, _file, _row) and what was masked ``before``."""
    at = F.col("_row")
    new = replaced.groupBy("_shard", F.col("_file").alias("file"), F.floor(at / MASK_ROWS).alias("bucket")).agg(
        F.bitmap_construct_agg(at % MASK_ROWS).alias("bits")
    )
    if before is not None:
        new = new.unionByName(before).groupBy("_shard", "file", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    new.write.partitionBy("_shard").parquet(layout.masks_path(dest, index, gen))


def most_mask_bytes(replaced: int, stored: int, n_files: int) -> int:
    """What the bitmaps of a shard take at most: one for each replaced row, or all of its files whole."""
    return MASK_BYTES * min(replaced, stored // MASK_ROWS + n_files)
