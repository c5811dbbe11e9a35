"""The Merkle manifest against a plain recursive one."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shardsmith.llm import merkle

SCHEMA = "doc_id bigint, source string, text string, n int, leaf string, pos string, top string, path int"
FIELDS = ["doc_id", "source", "n", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    told = [row[0], row[1], row[3], row[2]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told))


def tree(nodes, fanout):
    """(root, path of each node): the siblings to the left and right, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in zip(paths, at):
            run = nodes[i // fanout * fanout : i // fanout * fanout + fanout]
            p.append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
        at = [i // fanout for i in at]
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in order:
        groups[g].sort()
        subs[g] = tree([x[2] for x in groups[g]], fanout)
    root, tops = tree([subs[g][0] for g in order], fanout)
    out = Counter()
    for g, top in zip(order, tops):
        sub, paths = subs[g]
        for x, p in zip(groups[g], paths):
            out[x[3], x[2], sub, root, tuple(p + top)] += 1
    return out


def table():
    rng = random.Random(4)
    rows = [(i, rng.choice(("hot", "hot", "hot", "b", "\u00e9", "\U0001f600", "\uffee")), f"line\nof {i}", i % 4 or None, "l", "p", "t", 1) for i in range(400)]
    rows += [(1000 + i, f"s{i}", "x", 1, "l", "p", "t", 1) for i in range(12)]  # groups of one row
    rows += [(2000 + i, None, None if i % 2 else "", None, None, None, None, None) for i in range(7)]
    rows += [(3000, "", "long " * 50_000, 1, "l", "p", "t", 1), (3001, "", "", 1, "l", "p", "t", 1)]
    return [*rows, rows[5], rows[5], (5, rows[5][1], "same id", 1, "l", "p", "t", 1), (None, "b", "no id", 1, "l", "p", "t", 1), (None, None, None, None, None, None, None, None)]


@pytest.mark.parametrize("fanout,depth", [(3, 9), (2, 3), (5, 1)])
def test_manifest(spark, fanout, depth):
    """Windows of any depth give the same tree; several passes are needed for small ones."""
    docs = spark.createDataFrame(table(), SCHEMA).repartition(5)
    got = merkle.manifest(docs, FIELDS, "source", "doc_id", {"top": F.length("text")}, fanout, depth)
    assert got.columns == ["doc_id", "top", "leaf", "subroot", "root", "path"]
    want = brute(table(), fanout)
    rows = got.withColumns({"proof": merkle.proof_digest(F.col("path")), "folded": merkle.fold(F.col("leaf"), F.col("path"))}).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in rows) == want
    for r in rows:
        assert r.folded == r.root and r.proof == h(*(s.left + s.right for s in r.path))


def test_tampering(spark):
    docs = spark.createDataFrame(table(), SCHEMA)
    other = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("n"), F.replace("text", F.lit("\n"), F.lit("")))
    out = merkle.manifest(docs, FIELDS, "source", "doc_id", {"seen": other})
    out = out.withColumn("ok", merkle.fold(F.col("seen"), F.col("path")) == F.col("root")).collect()
    assert Counter(r.ok for r in out if r.doc_id is not None and r.doc_id < 400) == {False: 402, True: 1}
    assert all(r.ok for r in out if r.doc_id is None or r.doc_id >= 1000)


def test_small_tables(spark, monkeypatch):
    none = merkle.manifest(spark.createDataFrame([], SCHEMA), FIELDS, "source", "doc_id")
    assert none.collect() == [] and none.columns == ["doc_id", "leaf", "subroot", "root", "path"]
    one = merkle.manifest(spark.createDataFrame(table()[:1], SCHEMA), FIELDS, "source", "doc_id").head()
    assert one.leaf == one.subroot == one.root == leaf(table()[0]) and one.path == []
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0)  # the joins by shuffles
    rows = merkle.manifest(spark.createDataFrame(table(), SCHEMA), FIELDS, "source", "doc_id", None, 3, 2).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in rows) == brute(table(), 3)
