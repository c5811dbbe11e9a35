"""Reading a published index by name or alias (S4 + W11 + Q2 together)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardsmith.operators.search import get_by_id
from shardsmith.plans.alias import alias_rows, resolve_aliases
from shardsmith.plans import layout
from shardsmith.plans.build import latest_snapshot, path_exists, restore_snapshot


def resolve_name(spark: SparkSession, dest: str, name: str) -> str:
    """An alias resolves to its newest index; any other name is an index name."""
    if not path_exists(spark, layout.aliases_root(dest)):  # no alias written yet
        return name
    rows = resolve_aliases(alias_rows(spark, dest).where(F.col("alias") == name)).collect()
    return rows[0]["index"] if rows else name


def open_index(spark: SparkSession, dest: str, name: str) -> tuple[DataFrame, int]:
    """The newest committed documents of an index (or alias) and its shard count."""
    index = resolve_name(spark, dest, name)
    shards = latest_snapshot(spark, dest, index)["shards"]
    return restore_snapshot(spark, dest, index), shards


def lookup(spark: SparkSession, dest: str, name: str, ids: Iterable[str], routing: Iterable[str] | None = None) -> DataFrame:
    """Q2 by name: the shard count comes from the commit row, so a routed get
    always opens the right shard folder."""
    docs, shards = open_index(spark, dest, name)
    return get_by_id(docs, shards, ids, routing)
