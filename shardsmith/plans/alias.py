"""Aliases.  An alias row ``(alias, index, seq)`` points ``alias`` at
``index``; the row with the highest ``seq`` wins.  Rows are appended, never
rewritten, so pointing an alias elsewhere is one small append."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.plans import layout

ALIAS_SCHEMA = "alias string, index string, seq bigint"


def add_alias(spark: SparkSession, dest: str, alias: str, index: str, seq: int | None = None) -> None:
    seq = time.time_ns() if seq is None else seq
    row = spark.createDataFrame([(alias, index, int(seq))], ALIAS_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(layout.aliases_root(dest))


def alias_rows(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.schema(ALIAS_SCHEMA).parquet(layout.aliases_root(dest))


def resolve_aliases(rows: DataFrame) -> DataFrame:
    """Newest target per alias (ties on seq go to the greater index name).
    ``max(struct)`` aggregates partially on the map side."""
    best = rows.groupBy("alias").agg(F.max(F.struct("seq", "index")).alias("_best"))
    return best.select("alias", F.col("_best.index").alias("index"))


def resolve_alias(spark: SparkSession, dest: str, alias: str) -> str:
    rows = resolve_aliases(alias_rows(spark, dest).where(F.col("alias") == alias)).collect()
    if not rows:
        raise KeyError(f"alias {alias!r} is not defined under {dest!r}")
    return rows[0]["index"]
