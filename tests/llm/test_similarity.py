"""Fast similarity sketches: their properties, and components against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shardsmith.llm import pairs, similarity, sketches
from shardsmith.llm.common import scramble, words

SCHEMA = "doc_id bigint, text string, n int, sid string, comp string, kept string"


def some_set(rng, n):
    return np.unique(scramble(rng.integers(0, 2**63, n).astype(np.uint64)))


def test_sketches_are_filled():
    """Sets of every size fill all coordinates, as if sketched alone."""
    rng = np.random.default_rng(1)
    sets = [some_set(rng, n) for n in (1, 1, 2, 3, 5, 8, 30, 200, 1000, 20_000)]
    made = sketches.sketch(sets)
    assert (made != sketches.EMPTY).all()
    for s, row in zip(sets, made):
        assert (sketches.sketch([s])[0] == row).all()
    rounds = made >> np.uint64(32)
    assert rounds[-1].max() <= 1 and rounds[0].max() >= sketches.COORDS  # a large set needs a round or two, one shingle more than COORDS
    assert (rounds[rounds >= sketches.COORDS] < 2 * sketches.COORDS).all()
    assert (sketches.sketched([sets[0][:0], sets[5]])[1] == made[5]).all()


def test_coordinates_of_named_rounds():
    """Round COORDS + k fills coordinate k, from the whole set."""
    x = np.array([12345], np.uint64)
    row = sketches.sketch([x])[0] >> np.uint64(32)
    late = row >= sketches.COORDS
    assert late.any() and (row[late] == sketches.COORDS + np.flatnonzero(late)).all()


@pytest.mark.parametrize("j", [0.2, 0.5, 0.8, 0.95])
def test_agreement_is_concentrated(j):
    """The share of coordinates that agree is the similarity, with no more spread than of independent samples."""
    rng = np.random.default_rng(2)
    got = []
    for _ in range(150):
        n = int(rng.integers(20, 600))
        common = round(n * j)
        s = some_set(rng, 2 * n - common)
        a, b = s[:n], s[n - common :]
        x, y = sketches.sketch([a, b])
        real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got.append(((x == y).mean() - real, real))
    error = np.array([e for e, _ in got])
    p = np.mean([r for _, r in got])
    assert abs(error.mean()) < 0.01 and error.std() < 1.15 * np.sqrt(p * (1 - p) / sketches.COORDS)


def test_bands_and_prints():
    rng = np.random.default_rng(3)
    s = some_set(rng, 500)
    a, b = sketches.sketch([s, s[: int(len(s) * 0.85)]])
    ka, kb = similarity.bands(a[None])[0], similarity.bands(b[None])[0]
    same = (a == b).reshape(similarity.BANDS, similarity.ROWS).all(axis=1)
    assert same.any() and (ka == kb).tolist() == same.tolist() and len(set(ka.tolist())) == similarity.BANDS
    assert ((sketches.prints(a) == sketches.prints(b)) >= (a == b)).all()
    assert sketches.least_agreement(4, 5) < 0.8 * sketches.COORDS


def brute(rows):
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w))
    comp = list(range(len(rows)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((top(i), top(j)))
                comp[y] = x
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[top(i)].append(r[0])
    low = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return Counter((r[0], len(s), low[top(i)] if s else r[0], r[0] == (low[top(i)] if s else r[0])) for i, (r, s) in enumerate(zip(rows, sets)))


def rows():
    """Chains, stars and groups of copies about the threshold, and the edge cases."""
    rng = random.Random(10)
    prose = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    texts = []
    for n in (12, 40, 150, 600):
        for _ in range(4):
            base = prose(n)
            texts.append(base)
            for changes in range(1, 9):
                ws = list(base)
                for k in rng.sample(range(n), max(1, n * changes // 80)):
                    ws[k] = f"c{rng.randrange(10**6)}"
                texts.append(ws)
            walk = list(base)  # a chain: each copy of the one before
            for _ in range(6):
                walk[rng.randrange(n)] = f"d{rng.randrange(10**6)}"
                texts.append(list(walk))
    texts = [" ".join(t) for t in texts]
    texts += [texts[3], texts[3].upper(), None, "", " \n", "one", "ONE", "one two", "two one", "x " * 20_000, " ".join(prose(20_000)), "\u00e9 b c", "\u00c9 b c"]
    out = [(i, t, 1, "s", "c", "k") for i, t in enumerate(texts)]
    rng.shuffle(out)
    return [*out, out[0], out[0], (None, texts[0], 1, "s", "c", "k"), (None, "alone without id", 1, "s", "c", "k"), (None, None, None, None, None, None)]


def test_components(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    got = similarity.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    want = Counter()
    for (i, n, c, _), k in brute(rows()).items():
        want[i, n, c, i == c] += k
    assert Counter(map(tuple, got)) == want
    none = similarity.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns[0] == "doc_id"


def test_long_lists(spark, monkeypatch):
    """Lists that are cut into blocks, when hubs settle nothing, lose no link."""
    monkeypatch.setattr(pairs, "LIST", 4)
    monkeypatch.setattr(pairs, "BUCKET_ROWS", 16)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(60):  # pairs of twins that are far from each other pair
        ws = base[:200] + [f"p{i // 2}x{k}" for k in range(90)] + [f"q{rng.randrange(10**6)}" for _ in range(10)]
        docs.append((i, " ".join(ws), 1, "s", "c", "k"))
    got = similarity.near_duplicates(spark.createDataFrame(docs, SCHEMA)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == brute(docs)
    assert len({r.component_id for r in got}) == 30
