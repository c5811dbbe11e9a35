"""Routing and partitioning.

A document's shard is ``bucket(djb2(_routing), n)`` (R1 + R2).  The reference
also enumerates one *route string* per shard (R3) and maps route -> slot (R4);
both are offered as small n-row tables.  Shard-to-task placement is
``repartitionById`` on an INT column (R7), which puts shard *k* in Spark
partition *k* without a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardsmith.functions.hashing import hash_bucket


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def assign_shards(docs: DataFrame, n: int, routing: Column | str = "_routing") -> DataFrame:
    """``_shard = bucket(routing, n)``; the routing key defaults to
    ``_routing`` (which itself defaults to the id)."""
    return docs.withColumn("_shard", hash_bucket(_col(routing), n))


def route_table(
    spark: SparkSession,
    n: int,
    *,
    candidates: DataFrame | None = None,
    limit: int = 1_000_000,
    most: int = 1_000_000_000,
) -> DataFrame:
    """For each bucket the smallest candidate integer hitting it, and its
    slot = rank of that integer (discovery order).  Columns ``slot, route, bucket``.

    ``candidates`` is a one-column frame of non-negative integers.  By default
    the search goes up from 0: ``limit`` integers, then ten times as many for
    the buckets still missing, and so on up to ``most``, the caller's bound on
    the time it may take.  Fails, naming the missing buckets, if some bucket is
    never hit.  The result has at most ``n`` rows.
    """
    def first_hits(cand: DataFrame, missing: list[int]) -> dict[int, int]:
        hits = cand.where(F.col("x").isNotNull()).withColumn("bucket", hash_bucket(F.col("x").cast("string"), n))
        if len(missing) < n:
            hits = hits.where(F.col("bucket").isin(missing))
        return {r.bucket: r.x for r in hits.groupBy("bucket").agg(F.min("x").alias("x")).collect()}  # at most n rows

    if candidates is None:
        found: dict[int, int] = {}
        lo, hi = 0, min(limit, most)
        while lo < hi and len(found) < n:
            cand = spark.range(lo, hi).select(F.col("id").alias("x"))
            found |= first_hits(cand, [b for b in range(n) if b not in found])
            lo, hi = hi, min(hi * 10, most)
    else:
        found = first_hits(candidates.select(F.col(candidates.columns[0]).cast("bigint").alias("x")), list(range(n)))
    if len(found) < n:
        have = set(found)
        missing = [b for b in range(n) if b not in have]
        shown = ", ".join(map(str, missing[:50])) + (" ..." if len(missing) > 50 else "")
        raise ValueError(
            f"route table for n={n}: only {len(found)} of {n} buckets reached by the "
            f"candidates; missing buckets: {shown}"
        )
    # n rows: ranking them in one task is fine
    firsts = spark.createDataFrame([(b, x) for b, x in sorted(found.items())], "bucket int, x bigint")
    w = Window.orderBy("x")
    return firsts.select(
        (F.row_number().over(w) - 1).cast("int").alias("slot"),
        F.col("x").cast("string").alias("route"),
        "bucket",
    )


def route_lookup(df: DataFrame, route: Column | str, table: DataFrame) -> DataFrame:
    """Attach ``slot`` for a route string; an unknown route is an error.

    ``table`` is a route table (n rows), so broadcasting it is bounded by n.
    """
    small = F.broadcast(table.select(F.col("route").alias("_route_key"), "slot"))
    joined = df.withColumn("_route_key", _col(route).cast("string")).join(
        small, "_route_key", "left"
    )
    return joined.withColumn(
        "slot",
        F.when(F.col("slot").isNotNull(), F.col("slot")).otherwise(
            F.raise_error(F.concat(F.lit("unknown route: "), F.coalesce(F.col("_route_key"), F.lit("NULL"))))
        ).cast("int"),
    ).drop("_route_key")


def checked_shard(shard: Column, n: int) -> Column:
    """The shard column, failing loudly on NULL or out-of-range values
    (``repartitionById`` would silently take them modulo n)."""
    return F.when((shard >= 0) & (shard < n), shard.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"shard outside [0,{n}): "), F.coalesce(shard.cast("string"), F.lit("NULL"))))
    )


def shard_partition(docs: DataFrame, n: int, shard: str = "_shard") -> DataFrame:
    """R7 + R8: one Spark partition per shard, partition id == shard."""
    return docs.withColumn(shard, checked_shard(F.col(shard), n)).repartitionById(n, F.col(shard))


def shard_grid(spark: SparkSession, n: int, per_shard: DataFrame, shard: str = "shard") -> DataFrame:
    """Every shard 0..n-1 exactly once; shards without rows get 0s.

    ``per_shard`` holds at most one row per shard (n rows), so it is broadcast.
    """
    grid = spark.range(n).select(F.col("id").cast("int").alias(shard))
    value_cols = [c for c in per_shard.columns if c != shard]
    out = grid.join(F.broadcast(per_shard), shard, "left")
    return out.select(shard, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in value_cols])


def shard_skew(grid: DataFrame, docs_col: str = "docs") -> DataFrame:
    """Balance of a per-shard count grid: ``shards, max_docs, avg_docs, ratio``."""
    return grid.agg(
        F.count("*").alias("shards"),
        F.max(docs_col).cast("bigint").alias("max_docs"),
        F.avg(docs_col).alias("avg_docs"),
        (F.max(docs_col) / F.avg(docs_col)).alias("ratio"),
    )
