"""Periodic runs against brute force over all lags and places."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardsmith.llm import periodic, queries

SCHEMA = "doc_id bigint, text string, runs string, n_words int, collapsed int, extra string"


def brute(w, min_length=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            a = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - a >= max(q, min_length - q):
                found.setdefault((a - q, i), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def hard_texts():
    rng = random.Random(5)
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    yield b
    yield [bin(i).count("1") & 1 for i in range(400)]
    yield [0] * 200
    yield ([0] * 50 + [1]) * 4 + [0] * 49 + [1] + [0] * 53
    for _ in range(800):
        k, n = rng.choice((1, 2, 3, 5, 30)), rng.randrange(0, 140)
        w = [rng.randrange(k) for _ in range(n)]
        if n > 5 and rng.random() < 0.7:
            at = rng.randrange(n)
            p = rng.randrange(1, n - at + 1)
            w = w[:at] + [w[at + (i - at) % p] for i in range(at, n)]
            w += w[: rng.randrange(1, 12)] * rng.randrange(1, 8)
            w[rng.randrange(n)] = 77
        yield w
    for _ in range(200):
        w = sum(([rng.randrange(2) for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 20) for _ in range(rng.randrange(1, 12))), [])
        yield (w * rng.randrange(1, 4))[:500]


@pytest.mark.parametrize("min_length", [12, 2, 7])
def test_runs(min_length):
    for w in hard_texts():
        assert periodic.periodic_runs(np.array(w, np.int64), min_length) == brute(w, min_length)


def test_long_texts_stay_near_linear():
    """No text makes the candidates more than 2n for an octave."""
    rng = random.Random(6)
    for w in ([0] * 60_000, sum(([0] * rng.randrange(1, 60) + [1] for _ in range(2000)), [])):
        w, low = np.array(w, np.int64), 1
        while 2 * low <= len(w):
            step = (max(low, 13 - 2 * low) + 1) // 2
            at = np.arange(len(w) - step + 1)
            here, there = periodic._candidates(*periodic._repeated(periodic.Grams(w)(step, at), at), step, low, len(w))
            assert len(here) <= 2 * len(w) and (here - there >= low).all() and (here - there < 2 * low).all()
            low *= 2
    assert periodic.periodic_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def rows():
    rng = random.Random(8)
    long_ = " ".join(f"w{rng.randrange(300)}" for _ in range(20_000))
    texts = ["a b " * 9, "a b " * 9, None, "", " \n\t ", "A a " * 6, "one two", "x " * 30_000, "y" * 50_000, f"{long_} {long_}", "é\u2003ü " * 12, "a\x1cb " * 12]
    out = [(i, t, "r", 1, 2, "e") for i, t in enumerate(texts)]
    return [*out, out[0], (None, "z " * 12, None, None, None, None), (None, None, None, None, None, None)]


def test_collapse(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = periodic.collapse_runs(docs)
    assert got.columns == ["doc_id", "text", "extra", "n_words", "runs", "collapsed"]
    got = got.collect()
    assert len(got) == len(rows())
    for r in got:
        ws = r.text.encode().split() if r.text else []
        ids = {w: i for i, w in enumerate(dict.fromkeys(ws))}
        want = brute([ids[w] for w in ws]) if len(ws) < 500 else None
        runs = [tuple(x) for x in r.runs]
        assert r.n_words == len(ws) and (want is None or runs == want)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed.encode().split() == [w for i, w in enumerate(ws) if i not in gone]
    by_id = {r.doc_id: [tuple(x) for x in r.runs] for r in got if r.doc_id is not None}
    assert by_id[0] == [(0, 18, 2)] and by_id[7] == [(0, 30_000, 1)] and by_id[9] == [(0, 40_000, 20_000)]
    assert by_id[5] == [(0, 12, 2)] and by_id[6] == by_id[2] == by_id[4] == []
    assert periodic.collapse_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_planted_periods(spark):
    """The query's planted periods are those of its contract, word by word."""
    rng = random.Random(9)
    texts = {i: " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(0, 90))) for i in range(300)}
    docs = spark.createDataFrame([*texts.items(), (None, "a b"), (1000, None)], "doc_id bigint, text string")
    planted = 0
    for r in queries._with_periods(docs).collect():
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        w = texts.get(r.doc_id, "").split()
        if h % 10 or not w:
            assert r.text == texts.get(r.doc_id, "a b" if r.doc_id is None else None)
            continue
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        planted += 1
        assert r.text.split() == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    assert planted > 10 and queries._with_periods(docs).filter(F.col("text").isNull()).count() == 1
