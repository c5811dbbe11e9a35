"""Mixing sources to target weights by temperature.

Source s with token share p(s) gets weight p(s)^a, normalised.  The exponent
a is found by bisection (each step an aggregate over the table of sources that
tries many exponents at once): the largest a in [0, 1] at which the entropy of
the weights is ``target_entropy`` of its maximum or more, and no source is
repeated more than ``max_repeats`` times.  If no exponent can do it, a = 0
for the entropy, and for the repeats a = 1, where all sources repeat alike.

A source's quota is its weight times the budget.  It is realised in passes
over the source's blocks, each pass in another order: whole passes first, then
a last one up to the quota, cut within its last block, document by document.
``mix_pos`` puts all of it into one order from 0 to 1 in which every stretch
has the weights.

Defined cases: documents without words carry no tokens and take no part;
a null source is a source; equal rows are separate documents of one block,
null ids are allowed; ties in the order are broken by row key, then id, and
beyond that rows are equal; input columns named like an output are replaced;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shardsmith.llm.common import ROW_KEY, materialize, row_key

WORDS = r"[^\x20\x09-\x0D]+"
OUTPUT = ("n_tokens", "pass", "block", "mix_pos")


def count_tokens(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")


def shares(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """(source, tokens, docs) from ``n_tokens``; sources without tokens have none."""
    return docs.groupBy(F.col(source_col).alias("__source")).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).filter(F.col("tokens") > 0)


def _largest(table: DataFrame, holds, total: int, cuts: int = 16, rounds: int = 8) -> float:
    """The largest exponent in [0, 1] for which ``holds(z, zlog, least)`` is true, at 0 if for none.

    z = sum p^a, zlog = sum p^a ln p and ln of the least p, for ``cuts`` exponents in one aggregate.
    """
    lnp = F.log(F.col("tokens") / F.lit(float(total)))
    lo, hi = 0.0, 1.0
    for _ in range(rounds):
        tries = [lo + (hi - lo) * (i + 1) / cuts for i in range(cuts)]
        aggs = [x for i, a in enumerate(tries) for x in (F.sum(F.exp(a * lnp)).alias(f"z{i}"), F.sum(F.exp(a * lnp) * lnp).alias(f"l{i}"))]
        row = table.agg(F.min(lnp).alias("least"), *aggs).head()
        good = [holds(a, row[f"z{i}"], row[f"l{i}"], row["least"]) for i, a in enumerate(tries)]
        n = good.index(False) if False in good else cuts
        if n == cuts:
            return hi
        lo, hi = (tries[n - 1] if n else lo), tries[n]
    return lo


def find_exponent(table: DataFrame, target_entropy: float | None = 0.95, max_repeats: float | None = None, budget: int | None = None) -> float:
    """The exponent for a table of shares, rounded down to six places."""
    row = table.agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n")).head()
    total, n = int(row["total"] or 0), row["n"]
    if n < 2:
        return 1.0
    budget = total if budget is None else budget
    found = 1.0
    if target_entropy is not None:
        found = _largest(table, lambda a, z, l, _: math.log(z) - a * l / z >= target_entropy * math.log(n) - 1e-12, total)
    if max_repeats is not None:
        # the rarest source repeats most: p^(a-1) / z times; that falls as a grows, so the limit is a lower end
        fits = lambda a, z, least: math.exp((a - 1) * least) / z * budget / total <= max_repeats + 1e-12
        below = _largest(table, lambda a, z, _, least: not fits(a, z, least), total)
        found = max(found, min(1.0, below + 1e-6) if below > 0 else found)
    return math.floor(found * 1e6) / 1e6


def mix_sources(docs: DataFrame, target_entropy: float | None = 0.95, max_repeats: float | None = None, budget: int | None = None, block_tokens: int = 1 << 20, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row of ``docs`` for each time that it is used, with ``n_tokens``, ``pass``, ``block`` and ``mix_pos``."""
    names = [c for c in docs.columns if c not in OUTPUT]
    docs = docs.select(*names, row_key(id_col, text_col).alias(ROW_KEY), count_tokens(text_col).alias("n_tokens"))
    slim = materialize(docs.select(F.col(source_col), id_col, ROW_KEY, "n_tokens"), "mix_tokens")
    table = materialize(shares(slim, source_col), "mix_shares")
    total = int(table.agg(F.sum("tokens")).head()[0] or 0)
    a = find_exponent(table, target_entropy, max_repeats, budget)
    lnp = F.log(F.col("tokens") / F.lit(float(max(total, 1))))
    z = table.agg(F.sum(F.exp(a * lnp))).head()[0] or 1.0
    quotas = table.select(
        "__source", "tokens", F.round(F.exp(a * lnp) / z * (total if budget is None else budget)).cast("long").alias("quota"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("n_blocks"),
    )
    plan = materialize(_plan(slim, quotas, seed, id_col, source_col), "mix_plan")
    placed = _placed(docs, quotas, seed, id_col, source_col)
    on = placed["__source"].eqNullSafe(plan["__source"]) & (placed["block"] == plan["__block"])
    cols = [*names, ROW_KEY, "n_tokens", "block", "__order"]
    joined = placed.join(plan, on).select(*(placed[c] for c in cols), plan["__source"], "pass", "start", "room", "mix_pos")
    whole = joined.filter(F.col("room").isNull())
    order = W.partitionBy("__source", "pass", "block").orderBy("__order", ROW_KEY, id_col).rowsBetween(W.unboundedPreceding, 0)
    cut = joined.filter(F.col("room").isNotNull()).withColumn("__sum", F.sum("n_tokens").over(order)).filter(F.col("__sum") <= F.col("room")).drop("__sum")
    return whole.unionByName(cut).select(*names, "n_tokens", "pass", "block", "mix_pos")


def _placed(docs: DataFrame, quotas: DataFrame, seed: int, id_col: str, source_col: str) -> DataFrame:
    """Each document with tokens in its block, with a place in the order of the block that is cut."""
    q = quotas.select(F.col("__source").alias("__s"), "n_blocks")
    docs = docs.filter(F.col("n_tokens") > 0).join(q, F.col(source_col).eqNullSafe(F.col("__s")))
    spread = F.xxhash64(F.lit(seed), F.col(ROW_KEY), F.col(id_col))
    return docs.withColumn("block", F.pmod(spread, F.col("n_blocks"))).withColumn("__order", F.xxhash64(F.lit(seed + 1), F.col(ROW_KEY), F.col(id_col))).withColumnRenamed("__s", "__source").drop("n_blocks")


def _plan(slim: DataFrame, quotas: DataFrame, seed: int, id_col: str, source_col: str) -> DataFrame:
    """(source, pass, block, start, room, mix_pos): the blocks used; ``room`` (tokens) only for those cut."""
    blocks = _placed(slim, quotas, seed, id_col, source_col).groupBy("__source", F.col("block").alias("__block")).agg(F.sum("n_tokens").alias("size"))
    q = quotas.select(F.col("__source").alias("__s"), "tokens", "quota").filter(F.col("quota") > 0)
    last = F.floor((F.col("quota") - 1) / F.col("tokens")).cast("int")
    rows = blocks.join(q, F.col("__source").eqNullSafe(F.col("__s"))).drop("__s").withColumn("pass", F.explode(F.sequence(F.lit(0), last)))
    order = W.partitionBy("__source", "pass").orderBy(F.xxhash64(F.lit(seed), "pass", "__source", "__block"), "__block").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.sum("size").over(order) - F.col("size"))
    room = F.col("quota") - F.col("pass") * F.col("tokens") - F.col("start")
    return rows.filter(room > 0).select(
        "__source", "pass", "__block", "start", F.when(room < F.col("size"), room).alias("room"),
        ((F.col("pass") * F.col("tokens") + F.col("start")) / F.col("quota")).alias("mix_pos"),
    )
