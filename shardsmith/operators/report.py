"""Shard reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.operators.routing import shard_grid


def shard_counts(spark: SparkSession, prepared: DataFrame, n: int) -> DataFrame:
    """A1: per shard, documents submitted and accepted (every shard listed;
    documents without a routing value have a row with a NULL shard, so that the
    submitted ones add up to all that were scanned).

    ``prepared`` is the output of :func:`shardsmith.plans.build.prepare`
    (``_shard`` from routing, ``_status``)."""
    per = prepared.groupBy(F.col("_shard").alias("shard")).agg(
        F.count(F.lit(1)).alias("submitted"),
        F.count(F.when(F.col("_status") == "accepted", 1)).alias("accepted"),
    )
    grid = shard_grid(spark, n, per)
    return grid.unionByName(per.where(F.col("shard").isNull()).select(*grid.columns))


def reject_summary(rejects: DataFrame) -> DataFrame:
    """A3: refused documents per reason."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def shard_bytes(spark: SparkSession, docs: DataFrame, n: int, size: Column | None = None) -> DataFrame:
    """A4: logical size per shard (bytes of ``_source`` by default)."""
    size = size if size is not None else F.octet_length("_source")
    per = docs.groupBy(F.col("_shard").alias("shard")).agg(F.sum(size).cast("bigint").alias("bytes"))
    return shard_grid(spark, n, per)


def largest_shard(per_shard: DataFrame, size: str = "bytes") -> DataFrame:
    """A5: the biggest shard; ties go to the lowest shard number."""
    return per_shard.orderBy(F.desc(size), F.asc("shard")).limit(1)


def term_stats(docs: DataFrame, fields: list[str]) -> DataFrame:
    """Documents per (field, exact term) for keyword-like fields.

    Unpivot + group-by; the aggregation is partial on the map side, so a hot
    term costs one row per task before the shuffle."""
    long = docs.select(*[F.col(f).cast("string").alias(f) for f in fields]).unpivot(
        [], fields, "field", "term"
    )
    return (
        long.where(F.col("term").isNotNull())
        .groupBy("field", "term")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
