"""Links between sets that are still apart, found where the sets are compared.

Classes (sets, numbered ``cid``) come in *companies*: two classes that may
link have a hub in common.  All that is asked for are components, so pairs
within one are never looked at, and of the others only those come out whose
whole sets link: no list of candidate pairs exists anywhere.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardsmith.llm.common import materialize

LIST = 1024  # classes on each side of a list
BUCKET_ROWS, BUCKET_BYTES = 5_000, 16 << 20  # rows of lists in a bucket, and bytes of their sets, on average


def links(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets link: ``den * intersection >= num * union``."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return den * common >= num * (len(x) + len(y) - common)


def _sorted_sets() -> Callable[[bytes], np.ndarray]:
    return lambda shingles: np.frombuffer(shingles, np.uint64)


def company_lists(company: DataFrame, comp: DataFrame) -> DataFrame:
    """(list, cid, n, comp): the classes to be compared with one another, from companies (hub, cid, n) without repeats.

    A company within one component (``comp``: node, comp; a class that is no node is its own) has nothing left to
    compare.  In the others the component with the most classes is the *main* one: its classes are compared with the
    rest, and the rest with itself, in blocks of ``LIST`` classes on each side.  So a company that is all but one
    component costs about its own size, not its square.
    """
    label = comp.select(F.col("node").alias("cid"), F.col("comp").alias("__comp"))
    rows = company.join(label, "cid", "left").withColumn("comp", F.coalesce("__comp", "cid")).drop("__comp")
    of = rows.groupBy("hub", "comp").agg(F.count(F.lit(1)).alias("k"))
    of = of.groupBy("hub").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("all"))
    blocks = lambda n: F.ceil(n / LIST)
    of = of.filter(F.col("all") > F.col("m.k")).select("hub", F.col("m.comp").alias("main"), blocks(F.col("m.k")).alias("mains"), blocks(F.col("all") - F.col("m.k")).alias("rests"))
    rows = rows.join(of, "hub")
    h = F.xxhash64("cid")
    x, y = F.pmod(h, F.col("mains")), F.pmod(h, F.col("rests"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    name = lambda kind, i, j: F.xxhash64("hub", F.lit(kind), i, j)
    with_rest = F.transform(upto("rests"), lambda j: name(1, x, j))
    with_both = F.concat(F.transform(upto("mains"), lambda i: name(1, i, y)), F.transform(upto("rests"), lambda j: name(2, F.least(y, j), F.greatest(y, j))))
    return rows.select(F.explode(F.when(F.col("comp") == F.col("main"), with_rest).otherwise(with_both)).alias("list"), "cid", "n", "comp")


class Forest:
    """Numbers from 0 on, joined to components; ``at`` leads from each to the root of its component."""

    def __init__(self, n: int):
        self.at = np.arange(n)

    def root(self, i: int) -> int:
        at = self.at
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.at[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        while (self.at != (up := self.at[self.at])).any():
            self.at = up
        return self.at


def _each_pair(pdf: pd.DataFrame, comp: np.ndarray, joined: Forest, may_link: Callable, num: int, den: int):
    """(rows a, rows b) of the pairs of different components on a list of ``pdf`` (list, cid, n, prints; in that
    order of lists) whose sizes and prints allow a link.

    ``comp`` numbers the rows' components; those that the caller has ``joined`` in between are one from the next step on.
    """
    of, n = (pdf[c].to_numpy() for c in ("list", "n"))
    mine = np.frombuffer(b"".join(pdf["prints"]), np.uint8).reshape(len(pdf), -1)
    left, step = np.arange(len(pdf)), 1
    while len(left):  # each row with the one ``step`` after it on its list
        left = left[left + step < len(of)]
        left = left[of[left] == of[left + step]]
        right = left + step
        small, large = np.minimum(n[left], n[right]), np.maximum(n[left], n[right])
        now = joined.roots()[comp]
        ok = (now[left] != now[right]) & (den * small >= num * large)
        i, j = left[ok], right[ok]
        for k in range(0, len(i), 20_000):
            a, b = i[k : k + 20_000], j[k : k + 20_000]
            near = may_link(mine[a], mine[b], n[a], n[b])
            yield a[near], b[near]
        step += 1


def links_in_place(lists: DataFrame, sets: DataFrame, may_link: Callable, num: int, den: int, name: str | None = None, reader: Callable = _sorted_sets) -> DataFrame:
    """(a, b): links between different components, by which all are joined that any pair on a list links.

    A link between components that those found in the same bucket have joined already isn't looked for: a bucket gives
    fewer rows than it has components, however many of its pairs link.

    ``lists`` is a written table, ``sets`` holds (cid, shingles, prints): the sorted set and a short print of it, both
    as bytes.  ``may_link(prints of a, prints of b, sizes of a, sizes of b)`` rules pairs out by rows of prints; the
    sets of the others are compared whole, on their list.  With a ``name`` the lists are looked at with the prints
    alone before, and each class without a partner on a list leaves it: worth it where most classes have none.
    ``reader()`` returns a function that makes the sorted set of what ``sets`` has as ``shingles``.
    """
    if name is not None:
        lists = materialize(_with_partners(lists, sets, may_link, num, den), name)
    size = lists.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("s")).head()
    parts = max(1, size["n"] // BUCKET_ROWS, 8 * (size["s"] or 0) // BUCKET_BYTES)
    rows = lists.join(sets, "cid").select(F.pmod("list", F.lit(parts)).alias("bucket"), "list", "cid", "n", "comp", "prints", "shingles")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["list", "cid"])
        cid, whole = pdf["cid"].to_numpy(), list(map(reader(), pdf["shingles"]))
        # the components as far as the links of this bucket join them
        _, mine = np.unique(pdf["comp"].to_numpy(), return_inverse=True)
        joined = Forest(int(mine.max()) + 1)
        made: list[tuple[int, int]] = []
        failed: set[tuple[int, int]] = set()
        for a, b in _each_pair(pdf, mine, joined, may_link, num, den):
            for x, y in zip(a.tolist(), b.tolist()):
                pair = int(cid[x]), int(cid[y])
                if pair in failed or joined.root(mine[x]) == joined.root(mine[y]):
                    continue
                if links(whole[x], whole[y], num, den):
                    joined.join(mine[x], mine[y])
                    made.append(pair)
                else:
                    failed.add(pair)
        return pd.DataFrame(made, columns=["a", "b"], dtype="int64")

    return rows.groupBy("bucket").applyInPandas(compare, "a long, b long").distinct()


def _with_partners(lists: DataFrame, sets: DataFrame, may_link: Callable, num: int, den: int) -> DataFrame:
    """The rows of ``lists`` whose class has a partner on the list, by sizes and prints."""
    size = lists.agg(F.count(F.lit(1)).alias("n")).head()
    rows = lists.join(sets.select("cid", "prints"), "cid")
    rows = rows.select(F.pmod("list", F.lit(max(1, size["n"] // BUCKET_ROWS))).alias("bucket"), "list", "cid", "n", "comp", "prints")

    def partners(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["list", "cid"])
        has = np.zeros(len(pdf), bool)
        _, comp = np.unique(pdf["comp"].to_numpy(), return_inverse=True)
        for a, b in _each_pair(pdf, comp, Forest(int(comp.max()) + 1), may_link, num, den):
            has[a] = has[b] = True
        return pdf.loc[has, ["list", "cid", "n", "comp"]]

    return rows.groupBy("bucket").applyInPandas(partners, "list long, cid long, n long, comp long")
