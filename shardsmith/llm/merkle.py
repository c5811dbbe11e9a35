"""Merkle manifest of a table: a digest for each row, each group and all, with proofs.

H is the lowercase hex SHA-256 of its inputs, concatenated; digests go in as
hex text.  A row's leaf is H of its fields, each ``-`` if null, else the
number of its UTF-8 bytes, ``:`` and the value as text.  The leaves of a group
ascend by id; while there are several nodes, every ``fanout`` consecutive ones
(the last run may have fewer, even one) become their H.  What remains is the
group's subroot; the subroots, by group (null first, then bytewise), likewise
give the root.

Method: lag and lead windows.  Rows are numbered within their group, and for
each level a row that is the first leaf of a node reads its neighbours by lag
and lead at the fixed offsets of that level, ``j * fanout^level`` rows, masked
by the node's slot in its run and by the length of the run: these are its
siblings, and the first child's row hashes the parent.  Other rows take the
siblings of their node from its first leaf, by a running window.

A window holds ``fanout^depth`` consecutive rows of a group, a whole subtree
(19683 rows by default), so a group with a third of all rows is many windows,
and ``depth`` levels cost one shuffle of rows that hold digests only.  The
nodes on top of these subtrees, a table smaller by that factor, go through
the same function until one is left for each group, and so do the subroots.
Numbers come from a range partitioning: the place in a partition plus the
rows of the partitions before, a table of at most one row for each partition
and group.

Defined cases: a null group is a group of its own; null ids come first, rows
of equal ids go by their leaves, and equal rows are a leaf each; a group of
one row has its leaf as subroot, without siblings; null, empty and long
fields are hashed whole; other columns are ignored unless carried; a table
without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardsmith.llm.common import materialize

FANOUT, DEPTH = 3, 9
BROADCAST_ROWS = 20_000  # of the tables of spans and of upper nodes; larger ones are joined by a shuffle
SIDES = "array<struct<left:string,right:string>>"


def leaf_digest(*fields: Column) -> Column:
    def told(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, fields)), 256)


def proof_digest(path: Column) -> Column:
    """H of the siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by its siblings."""
    return F.reduce(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def _small(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast if it is known to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _number(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (``group``, never null, and more) with ``pos``, their place in the group by ``order``, and ``count``, its rows."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["group", *order]
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = materialize(placed.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), name)
    spans = placed.groupBy("group", "__part").agg(F.min("__at").alias("__low"), F.count(F.lit(1)).alias("__n"))
    group = W.partitionBy("group")
    before = F.coalesce(F.sum("__n").over(group.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("group", "__part", (before - F.col("__low")).alias("__shift"), F.sum("__n").over(group).alias("count"))
    placed = placed.join(_small(materialize(spans, name)), ["group", "__part"])
    return placed.withColumn("pos", F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def _subtrees(rows: DataFrame, fanout: int, depth: int) -> DataFrame:
    """``rows`` (``group``, ``pos``, ``count``, ``node``) with ``block``, ``top`` (at a block's first row, the node on top)
    and, for each level, the siblings to the left and right of the row's node, null above a group's root."""
    rows = rows.withColumn("block", F.floor(F.col("pos") / fanout**depth))
    block = W.partitionBy("group", "block").orderBy("pos")
    rows = rows.withColumn("top", F.col("node"))
    for k in range(depth):
        step = fanout**k
        slot = F.floor(F.col("pos") / step) % fanout
        several = F.col("count") > step
        at = {f"__lag{j}": F.lag("top", j * step).over(block) for j in range(1, fanout)}
        at |= {f"__lead{j}": F.lead("top", j * step).over(block) for j in range(1, fanout)}
        rows = rows.withColumns(at)
        left = F.concat_ws("", *(F.when(slot >= j, F.col(f"__lag{j}")) for j in range(fanout - 1, 0, -1)))
        right = F.concat_ws("", *(F.when((slot + j < fanout) & (F.col("pos") + j * step < F.col("count")), F.col(f"__lead{j}")) for j in range(1, fanout)))
        here = several & (F.col("pos") % step == 0)
        rows = rows.withColumns({f"__l{k}": F.when(here, left), f"__r{k}": F.when(here, right)})
        parent = F.when(several, F.sha2(F.concat("top", f"__r{k}"), 256)).otherwise(F.col("top"))
        rows = rows.withColumn("top", F.when(F.col("pos") % (step * fanout) == 0, parent)).drop(*at)
    so_far = block.rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumns({f"__{s}{k}": F.last(f"__{s}{k}", ignorenulls=True).over(so_far) for k in range(depth) for s in "lr"})


def _climb(rows: DataFrame, fanout: int, depth: int, name: str) -> DataFrame:
    """``rows`` (``group``, ``pos``, ``count``, ``node``, others) with ``path``, the siblings from each node up to its group's
    root, and ``top``, that root, in place of ``node`` and ``count``."""
    most = rows.agg(F.max("count")).head()[0] or 0
    rows = materialize(_subtrees(rows, fanout, depth), name)
    up = rows.filter(F.col("pos") % fanout**depth == 0).select("group", F.col("block").alias("pos"), F.ceil(F.col("count") / fanout**depth).alias("count"), F.col("top").alias("node"))
    path = F.filter(F.array(*(F.when(F.col(f"__l{k}").isNotNull(), F.struct(F.col(f"__l{k}").alias("left"), F.col(f"__r{k}").alias("right"))) for k in range(depth))), lambda s: s.isNotNull())
    rest = [c for c in rows.columns if not c.startswith("__l") and not c.startswith("__r") and c not in ("count", "node", "block", "top")]
    if most > fanout**depth:
        up = materialize(_climb(up, fanout, depth, name).select("group", F.col("pos").alias("block"), F.col("path").alias("__up"), "top"), name)
        rows = rows.drop("top").join(_small(up), ["group", "block"])
        return rows.select(*rest, F.concat(path, "__up").alias("path"), "top")
    tops = up.select("group", F.col("node").alias("__top"))
    rows = rows.join(_small(materialize(tops, name)), "group")
    return rows.select(*rest, path.alias("path"), F.col("__top").alias("top"))


def manifest(
    docs: DataFrame, fields: list[str], group_col: str, id_col: str, carry: dict[str, Column] | None = None, fanout: int = FANOUT, depth: int = DEPTH
) -> DataFrame:
    """(id, columns of ``carry``, leaf, subroot, root, path) for every row; ``path`` holds the siblings to the left and to
    the right for each level from the leaf to the root.  ``carry`` are expressions over ``docs``."""
    carry = carry or {}
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # in the order of the groups, null first
    rows = docs.select(group.alias("group"), F.col(id_col).alias("__id"), leaf_digest(*(F.col(f) for f in fields)).alias("node"), *(c.alias(f"c_{n}") for n, c in carry.items()))
    rows = _number(materialize(rows, "merkle_leaves"), ["__id", "node"], "merkle_places")
    rows = rows.withColumnsRenamed({"__id": "id"}).withColumn("leaf", F.col("node"))
    rows = materialize(_climb(rows, fanout, depth, "merkle_nodes"), "merkle_paths")
    subroots = rows.filter("pos = 0").select(F.lit("").alias("group"), F.col("group").alias("of"), F.col("top").alias("node"))
    subroots = _number(materialize(subroots, "merkle_subroots"), ["of"], "merkle_places")
    roots = _climb(subroots, fanout, depth, "merkle_nodes").select(F.col("of").alias("group"), F.col("path").alias("__up"), F.col("top").alias("root"))
    out = rows.join(_small(materialize(roots, "merkle_roots")), "group")
    return out.select(F.col("id").alias(id_col), *(F.col(f"c_{n}").alias(n) for n in carry), "leaf", F.col("top").alias("subroot"), "root", F.concat("path", "__up").alias("path"))
