"""Continuous upserts (W10 on a stream).

New JSON lines arriving in a folder are applied to a published index, one
new generation per micro-batch (a delta layer or a shard rewrite, chosen by
size), through ``foreachBatch``.  Every commit carries the last batch of each
query, so a micro-batch that is replayed after a failure (Structured Streaming
re-runs the last uncommitted batch) is told from the newest commit alone, and
skipped: at most one generation per batch.  A stream that starts over with a
new checkpoint numbers its batches anew, so it needs a new ``query_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardsmith.operators.documents import documents_from_lines
from shardsmith.plans.build import IndexSpec, newest_snapshot, upsert


def apply_batch(spark: SparkSession, lines: DataFrame, batch_id: int, dest: str, spec: IndexSpec,
                id_field: str, seq_field: str | None = None, routing_field: str | None = None,
                query_name: str = "stream", mode: str = "auto") -> str | None:
    newest = newest_snapshot(spark, dest, spec.index)
    if newest and (newest.get("batches") or {}).get(query_name, -1) >= batch_id:
        return None
    docs = documents_from_lines(lines, id_field=id_field, seq_field=seq_field, routing_field=routing_field)
    tag = f"{query_name}:{batch_id}"
    return upsert(spark, docs, dest, spec, tag=tag, mode=mode, batch=(query_name, batch_id)).generation


def start_upsert_stream(
    spark: SparkSession,
    source_dir: str,
    dest: str,
    spec: IndexSpec,
    *,
    id_field: str,
    checkpoint: str,
    seq_field: str | None = None,
    routing_field: str | None = None,
    query_name: str = "stream",
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    mode: str = "auto",
):
    """Start the stream; returns the ``StreamingQuery``.  A micro-batch that is
    small next to the shards it touches becomes a delta layer (cost follows
    the batch, not the index); a large one, or one landing on shards whose
    layers have grown, rewrites those shards, which folds their layers."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.text(source_dir).select("value")

    def each(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch.sparkSession, batch, batch_id, dest, spec, id_field, seq_field, routing_field, query_name, mode)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
