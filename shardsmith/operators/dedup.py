"""Last write wins (N2) and bulk numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardsmith.session import shared_dir


def latest_by_id(docs: DataFrame, keys: tuple[str, ...] = ("_shard", "_id"), seq: str = "_seq") -> DataFrame:
    """One row per key, the one with the highest ``seq``; ties go to the
    greater ``_source`` so the choice does not depend on arrival order.
    Planned as a rank-1 window, which Spark turns into a WindowGroupLimit."""
    order = [F.desc(seq)] + ([F.desc("_source")] if "_source" in docs.columns else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    return docs.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def assign_bulks(
    docs: DataFrame,
    bulk_size: int = 10_000,
    *,
    shard: str = "_shard",
    order: tuple[str, ...] = ("_seq", "_id"),
    partitions: int | None = None,
) -> DataFrame:
    """Number each shard's documents in ``order`` and cut them into bulks
    of ``bulk_size``: adds ``_rank`` (0-based within the shard) and ``_bulk``.

    A shard is not funnelled through one task: rows are range-partitioned on
    (shard, order) and written, with their task and place, to the shared
    folder; a task's offset within a shard is the sum of the counts of earlier
    tasks.  Counts and rows are read from the same files, so they can't differ
    whatever columns are kept.  The count table has at most (tasks + shards)
    rows, since each task holds one contiguous key range.  Rows equal in
    ``order`` get ranks of their own, in no stated order.
    """
    if bulk_size < 1:
        raise ValueError("bulk_size must be >= 1")
    spark = docs.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [shard, *order]
    ranged = (
        docs.repartitionByRange(n_parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mono", F.monotonically_increasing_id())
    )
    path = shared_dir(spark, "bulks", unique=True)
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("_pid", shard).agg(
        F.min("_mono").alias("_first"), F.count(F.lit(1)).alias("_cnt")
    )
    w = Window.partitionBy(shard).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    ranked = ranged.join(F.broadcast(offsets), ["_pid", shard]).withColumn(
        "_rank", F.col("_offset") + F.col("_mono") - F.col("_first")
    )
    return ranked.withColumn("_bulk", F.floor(F.col("_rank") / bulk_size).cast("bigint")).drop(
        "_pid", "_mono", "_first", "_offset"
    )


def bulk_summary(bulked: DataFrame, bulk_size: int, shard: str = "_shard") -> DataFrame:
    """Per shard: number of bulks and size of the last one, in one aggregation
    (ranks are contiguous, so every bulk but the last is full)."""
    return bulked.groupBy(F.col(shard).alias("shard")).agg(
        (F.max("_bulk") + 1).alias("bulks"),
        (F.count(F.lit(1)) - F.max("_bulk") * bulk_size).alias("last_bulk_docs"),
    )
