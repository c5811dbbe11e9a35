"""op12_similarity_sketch on one large group of near copies: little is compared whole, few rounds are run."""

import random

import numpy as np

from shardsmith.llm import pairs, similarity
from shardsmith.llm.ngram_join import components


def test_few_sets_are_compared_whole(spark, monkeypatch):
    """Copies of one text, a bit too far from each other to link: most pairs are ruled out before their whole sets are compared."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(60):
        ws = list(base)
        for k in rng.sample(range(200), 9):
            ws[k] = f"c{i}x{k}"
        docs.append((i, " ".join(ws)))
    docs.append((60, docs[7][1] + " end"))
    seen, real = [], similarity.links_in_place

    def spy(lists, sets, near, num, den):
        seen.append((near, sorted(sets.collect())))
        return real(lists, sets, near, num, den)

    monkeypatch.setattr(similarity, "links_in_place", spy)
    got = {r.doc_id: r.component_id for r in similarity.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    [(near, rows)] = seen
    whole = [np.frombuffer(r.shingles, np.uint64) for r in rows]
    prints = np.array([np.frombuffer(r.prints, np.uint8) for r in rows])
    n = np.array([len(s) for s in whole])
    assert len(rows) == 61
    i, j = np.triu_indices(len(rows), 1)
    passed = near(prints[i], prints[j], n[i], n[j])
    linked = np.array([pairs.links(whole[x], whole[y], 4, 5) for x, y in zip(i, j)])
    assert passed[linked].all() and linked.any()
    assert passed.sum() < 0.1 * len(i) + linked.sum()
    assert got[60] == got[7] == 7 or got[60] == got[7] < 7


def test_components_are_a_written_table(spark):
    """Smallest nodes of random graphs, chains and stars; what is returned is written, so that no use of it shuffles again."""
    rng = random.Random(13)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 1999 - i) for i in range(60)] + [(3000, 3000 + i) for i in range(60)]
    edges += edges[:20] + [(None, 5), (5, None)]
    comp = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((comp.setdefault(a, a), comp.setdefault(b, b)))
            comp.update({k: x for k, v in comp.items() if v == y})
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), "test_components")
    assert sorted(map(tuple, found.select("node", "comp").collect())) == sorted(comp.items())
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    none = components(spark.createDataFrame([(1, 1)], "a bigint, b bigint"), "test_components")
    assert none.collect() == []
