"""Cases of the second review, each of which gave a wrong or a partial result before."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
import pytest

from conftest import SF001
from shardsmith.llm import decontaminate, ngram_join, quality, runs
from shardsmith.llm.common import ROW_KEY, WordHasher, shingle_hashes


@pytest.mark.parametrize("by_documents", [True, False])
@pytest.mark.parametrize("at_least", [2, 10])
def test_runs_across_batches(spark, by_documents, at_least):
    """Runs that go on over the edges of Arrow batches and partitions."""
    rng = random.Random(7)
    rows = [(k, 1, d, d, p) for k in range(60) for d in range(rng.choice((1, 2, 3, 9, 12, 40))) for p in range(rng.choice((1, 1, 2)))]
    rng.shuffle(rows)
    of = defaultdict(list)
    for r in rows:
        of[r[0]].append((r[2], r[4]))
    enough = {k: len({d for d, _ in v} if by_documents else v) >= at_least for k, v in of.items()}
    want = sorted((k, d, p, (d, p) == min(of[k])) for k, _, d, _, p in rows if enough[k])
    old = {c: spark.conf.get(c) for c in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        df = spark.createDataFrame([(*r, r[0]) for r in rows], f"k1 long, k2 long, doc_id long, {ROW_KEY} long, pos long, key long")
        got = runs.mark_runs(df, "doc_id", at_least, by_documents, "test_runs")
        got = [tuple(r) for r in got.select("key", "doc_id", "pos", "is_first").collect()]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sorted(got) == want


def test_groups_of_null_ids(spark):
    """Different texts without ids are different groups; copies among them are one."""
    rng = random.Random(12)
    texts = [" ".join(f"w{i}x{rng.randrange(400)}" for _ in range(80)) for i in range(3)]
    near = " ".join(["other", *texts[0].split()[1:]])
    docs = spark.createDataFrame([(None, t) for t in (*texts, texts[1], near)], "doc_id bigint, text string")
    kept = [r.text for r in corpus_pipeline.one_of_each_group(spark, docs, SF001).collect()]
    assert len(kept) == 3 and set(texts[1:]) <= set(kept) and len({texts[0], near} & set(kept)) == 1
    found = ngram_join.jaccard_components(docs)
    assert found.filter("component_key is null").count() == 0 and found.select("component_key").distinct().count() == 3


def garbage(rng, n):
    return " ".join(f"☃{rng.randrange(9)}☄{rng.randrange(9)}" for _ in range(n))


def test_small_quality_groups(spark):
    """A bad document is rejected however few share its language and length; good ones stay."""
    rng = random.Random(13)
    prose = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    docs = [(i, prose(120), "en") for i in range(49)] + [(100, garbage(rng, 120), "en"), (101, garbage(rng, 3000), "en"), (102, garbage(rng, 120), "xx"), (103, garbage(rng, 120), None)]
    docs += [(200, prose(6000), "en"), (201, prose(60), "en"), (202, prose(120), "xx"), (203, prose(120), None)]
    for few in (docs, docs + [(300 + i, prose(120), "en") for i in range(20)]):
        got = quality.quality_rules(spark.createDataFrame(few, "doc_id bigint, text string, lang string")).filter("not kept and not base_failed")
        assert sorted(r.doc_id for r in got.collect()) == [100, 101, 102, 103]
    planted = [(i, prose(120), "en") for i in range(80)] + [(80, " ".join(f"☃{rng.randrange(9)}☄" for _ in range(120)), "en")]
    got = quality.quality_rules(spark.createDataFrame(planted, "doc_id bigint, text string, lang string"), min_group=20)
    assert [r.doc_id for r in got.filter("not kept").collect()] == [80]


def brute_windows(h, bench, k):
    """The most similar window of an item's length, the earliest of equal ones, over all starts."""
    n = bench.lengths[k]
    if not bench.shingles[k].keys() & set(shingle_hashes(h).tolist()) and n >= 5:
        return None
    tried = [(bench.similarity(h[max(q, 0) : q + n], k), -max(q, 0), min(q + n, len(h)) - max(q, 0)) for q in range(1 - n, len(h))]
    s, lo, words = max(tried, key=lambda x: x[:2])
    return (k, s, -lo, words) if s >= 0.75 else None


def changed(rng, ws, at, how):
    ws = list(ws)
    for i in sorted(at, reverse=True):
        ws[i : i + 1] = {"replace": ["changed"], "insert": ["added", ws[i]], "delete": []}[how]
    return ws


def test_decontamination_is_whole():
    """Copies with changes in any places are found as by brute force over all windows."""
    rng = random.Random(14)
    item = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    items = [item(n) for n in (15, 18, 26, 40, 53, 74, 120, 200, 3)]
    items += [[*items[3][:20], *item(20)], items[4] * 2, item(30) * 2]  # shared shingles and repeated ones
    shared = Counter(s for ws in items for s in set(shingle_hashes(WordHasher()(" ".join(ws))).tolist()))
    bench = decontaminate.Benchmark([" ".join(ws) for ws in items], 3, {s: 1 / n for s, n in shared.items() if n > 1}, 0.75)
    copies = [(2, (0, 25), "replace"), (3, (0, 39), "replace"), (5, (10, 50), "replace")]
    for k, ws in enumerate(items):
        copies += [(k, rng.sample(range(len(ws)), min(c, len(ws) - 1)), how) for how in ("replace", "insert", "delete") for c in (0, 1, 2, 4) for _ in range(2)]
    texts = []
    for k, at, how in copies:
        ws = changed(rng, items[k], at, how)
        turn = rng.choice((0, 0, len(ws) // 2))  # some with their halves exchanged, some at an end of the text
        texts.append([*item(rng.choice((0, 30))), *ws[turn:], *ws[:turn], *item(rng.choice((0, 30)))])
    got = bench.search([" ".join(ws) for ws in texts])
    hits = 0
    for ws, found in zip(texts, got):
        h = WordHasher()(" ".join(ws))
        want = [x for k in range(len(items)) if (x := brute_windows(h, bench, k))]
        assert found == want
        hits += len(want)
    assert all(any(f[0] == k for f in got[i]) for i, (k, _, _) in enumerate(copies[:3])) and hits > 100
