"""Read side of a restored index: predicates, top-k search (Q1), get by id (Q2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardsmith.functions.hashing import bucket_py, hash_bucket


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def term(field: Column | str, *values) -> Column:
    """Exact term (one value) or terms (several) on a not-analysed field."""
    return _c(field) == values[0] if len(values) == 1 else _c(field).isin(list(values))


def range_(field: Column | str, *, gte=None, gt=None, lte=None, lt=None) -> Column:
    c = _c(field)
    conds = []
    if gte is not None:
        conds.append(c >= gte)
    if gt is not None:
        conds.append(c > gt)
    if lte is not None:
        conds.append(c <= lte)
    if lt is not None:
        conds.append(c < lt)
    if not conds:
        return c.isNotNull()
    out = conds[0]
    for x in conds[1:]:
        out = out & x
    return out


def exists(field: Column | str) -> Column:
    return _c(field).isNotNull()


def search(
    index: DataFrame,
    where: Column | None = None,
    *,
    columns: Iterable[str] | None = None,
    sort: Iterable[Column | str] | None = None,
    size: int | None = None,
) -> DataFrame:
    """Q1: filter (pushed to the Parquet scan), project, and optionally the
    top ``size`` rows by ``sort`` (a per-task top-k, then one small merge)."""
    out = index if where is None else index.where(where)
    if columns is not None:
        out = out.select(*columns)
    if sort is not None:
        out = out.orderBy(*[_c(s) for s in sort])
    if size is not None:
        if sort is None:
            raise ValueError("size needs a sort order, or the rows returned are arbitrary")
        out = out.limit(size)
    return out


def get_by_id(index: DataFrame, n: int, ids: Iterable[str], routing: Iterable[str] | None = None) -> DataFrame:
    """Q2: fetch documents by id.  The shard is computed on the driver from the
    routing (default: the id), so the scan only opens those shard folders.
    One list of ids for each shard, so the condition is as deep as the log of
    the number of shards; for ids by the million use :func:`multi_get`."""
    ids = [str(i) for i in ids]
    routes = [str(r) for r in routing] if routing is not None else ids
    if len(routes) != len(ids):
        raise ValueError("ids and routing differ in length")
    by_shard: dict[int, list[str]] = {}
    for i, r in zip(ids, routes):
        by_shard.setdefault(bucket_py(r, n), []).append(i)
    conds = [(F.col("_shard") == s) & _one_of(wanted) for s, wanted in sorted(by_shard.items())]
    return index.where(_any(conds)) if conds else index.limit(0)


def _any(conds: list[Column]) -> Column:
    """A balanced disjunction."""
    while len(conds) > 1:
        conds = [a | b for a, b in zip(conds[::2], conds[1::2])] + (conds[-1:] if len(conds) % 2 else [])
    return conds[0]


# Ids of a shard that go to the scan one by one.  A longer IN list reaches it as a range only, which Bloom filters can't answer.
PUSHED_IDS = 256


def _one_of(ids: list[str]) -> Column:
    ids = sorted(set(ids))
    return _any([F.col("_id") == i for i in ids]) if len(ids) <= PUSHED_IDS else F.col("_id").isin(ids)


# Most bytes of ids that are broadcast to every task, and what a key takes in the broadcast table besides its id.
BROADCAST_ID_BYTES = 64 << 20
KEY_OVERHEAD = 48


def multi_get(
    index: DataFrame,
    n: int,
    wanted: DataFrame,
    id_col: str = "_id",
    routing_col: str | None = None,
    broadcast_bytes: int = BROADCAST_ID_BYTES,
    pushed_ids: int = PUSHED_IDS,
) -> DataFrame:
    """Q2 for many ids held in a DataFrame: semi-join on (shard, id).

    The distinct requested keys are counted and measured first.  Up to
    ``pushed_ids`` go into the filter as in :func:`get_by_id`: shard folders
    are pruned and row groups skipped by the Bloom filters of their ids.  Up to
    ``broadcast_bytes`` they are broadcast, so the index side is never shuffled
    and Spark prunes shard folders at run time (dynamic partition pruning on
    ``_shard``).  Above that it is an ordinary shuffled join."""
    keys = wanted.select(
        F.col(id_col).cast("string").alias("_id"),
        hash_bucket(F.col(routing_col or id_col).cast("string"), n).alias("_shard"),
    ).distinct()
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("_id")), F.lit(0)).alias("b")).first()
    if size["n"] <= pushed_ids:
        conds = [(F.col("_shard") == r["_shard"]) & (F.col("_id") == r["_id"]) for r in keys.where("_id IS NOT NULL").collect()]
        return index.where(_any(conds)) if conds else index.limit(0)
    if size["b"] + KEY_OVERHEAD * size["n"] <= broadcast_bytes:
        keys = F.broadcast(keys)
    return index.join(keys, ["_shard", "_id"], "left_semi")
