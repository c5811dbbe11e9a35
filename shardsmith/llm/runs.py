"""Runs of equal hashes over range-partitioned, sorted rows.

Rows are range-partitioned by (hash, document) and sorted by (hash, document,
position); one pass over each partition then finds the runs of equal hashes.
The document is part of the range key, so a hash that a third of all rows
share is spread over many partitions.  Only the first and the last run of a
partition can go on in another one; their rows are set aside and settled by
a table of at most two rows for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import ROW_KEY, materialize

SETTLED, EDGE, SUMMARY = 0, 1, 2


def mark_runs(rows: DataFrame, doc: str, at_least: int, by_documents: bool, name: str) -> DataFrame:
    """The rows of all hashes found at least ``at_least`` times.

    ``rows``: ``k1``, ``k2`` (long, the hash), the document's id and row key,
    ``pos`` and any further columns.  Counted are documents
    (``by_documents``) or rows.  Returned without ``k1`` and ``k2``, with
    ``is_first``: the hash's first row by document, then position.
    """
    order = ["k1", "k2", doc, ROW_KEY, "pos"]
    rest = [c for c in rows.columns if c not in ("k1", "k2")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("k1", "k2", *rest).repartitionByRange(parts, "k1", "k2", doc, ROW_KEY).sortWithinPartitions(*order)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema), T.StructField("state", T.IntegerType()), T.StructField("is_first", T.BooleanType()), T.StructField("part", T.IntegerType()), T.StructField("n", T.LongType())])
    key_at = rows.columns.index(ROW_KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        yield from _stream(batches, TaskContext.get().partitionId(), key_at, at_least, by_documents, schema.names)

    marks = materialize(rows.mapInArrow(run, schema), name)
    edges = (
        marks.filter(F.col("state") == SUMMARY)
        .groupBy("k1", "k2")
        .agg(F.sum("n").alias("__n"), F.min("part").alias("__part"))
        .filter(F.col("__n") >= at_least)
    )
    settled = marks.filter(F.col("state") == SETTLED).select(*rest, "is_first")
    # at most two rows for each partition of the sort, so this broadcast is bounded
    open_ = marks.filter(F.col("state") == EDGE).join(F.broadcast(edges), ["k1", "k2"])
    return settled.unionByName(open_.select(*rest, (F.col("is_first") & (F.col("part") == F.col("__part"))).alias("is_first")))


def _stream(batches, part: int, key_at: int, at_least: int, by_documents: bool, names: list[str]) -> Iterator[pa.RecordBatch]:
    key = last = None  # of the run that is open
    count, leading, started = 0, True, False
    held: list[tuple[pa.RecordBatch, np.ndarray]] = []  # rows of the open run while it is below the threshold

    def out(b: pa.RecordBatch, state: int, first: np.ndarray) -> pa.RecordBatch:
        n = b.num_rows
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, state, np.int32)), pa.array(first), pa.array(np.full(n, part, np.int32)), pa.array(np.zeros(n, np.int64))], names=names)

    def summary(like: pa.RecordBatch) -> pa.RecordBatch:
        cols = [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), *(pa.nulls(1, f.type) for f in list(like.schema)[2:])]
        return pa.RecordBatch.from_arrays([*cols, pa.array([SUMMARY], pa.int32()), pa.array([False]), pa.array([part], pa.int32()), pa.array([count], pa.int64())], names=names)

    b = None
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        k1, k2, doc = (b.column(i).to_numpy() for i in (0, 1, key_at))
        new = np.ones(n, bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        new[0] = key != (k1[0], k2[0])
        unit = np.ones(n, np.int64)
        if by_documents:
            unit[1:] = new[1:] | (doc[1:] != doc[:-1])
            unit[0] = new[0] or doc[0] != last
        starts = np.flatnonzero(new)
        head = int(starts[0]) if len(starts) else n  # rows that go on with the open run
        if head:
            more, first = b.slice(0, head), np.zeros(head, bool)
            count += int(unit[:head].sum())
            if leading:
                yield out(more, EDGE, first)
            elif count >= at_least:
                for x, f in held:
                    yield out(x, SETTLED, f)
                held = []
                yield out(more, SETTLED, first)
            else:
                held.append((more, first))
        if len(starts):
            if key is not None and leading:
                yield summary(b)
            held = []  # a run that has ended below the threshold
            total = np.add.reduceat(unit, starts)
            size = np.diff(np.append(starts, n))
            tail = int(starts[-1])  # the last run stays open
            opens = 0
            if not started:  # the partition's first run
                opens = int(size[0]) if len(starts) > 1 else n
            started = True
            good = np.zeros(n, bool)  # of all rows: the first ``head`` belong to the run before
            good[head:] = np.repeat(total >= at_least, size)
            good[tail:] = False
            good[:opens] = False
            if len(starts) > 1 and opens:
                key, count = (int(k1[0]), int(k2[0])), int(total[0])
                yield out(b.slice(0, opens), EDGE, new[:opens])
                yield summary(b)
            if good.any():
                at = np.flatnonzero(good)
                yield out(b.take(pa.array(at)), SETTLED, new[at])
            key, count = (int(k1[tail]), int(k2[tail])), int(total[-1])
            leading = opens == n
            rows, first = b.slice(tail), new[tail:]
            if leading:
                yield out(rows, EDGE, first)
            elif count >= at_least:
                yield out(rows, SETTLED, first)
            else:
                held = [(rows, first)]
        last = doc[-1]
    if key is not None:
        for x, f in held:
            yield out(x, EDGE, f)
        yield summary(b)
