"""Benchmark decontamination: SimHash windows, Hamming blocks, exact check.

Windows of five words, as long as a shingle, slide over each text.  Each has a
64-bit SimHash of its words.  A benchmark item is probed by some of its own
windows: so many that their shingles weigh more than what a copy may lose at
the threshold.  Any window of a text that is similar enough then has one of
them at distance 0, wherever and in however many places it was changed.
Fingerprints are cut into ``radius + 1`` blocks: two within the radius agree
in one block at least, so the block tables find every pair within the radius.
Around a pair all item-sized windows that hold it are compared exactly by
weighted Jaccard similarity of their 5-word shingles; those at the ends of a
text may be cut short.  A shingle weighs one over the number of items that
have it, 1 if none.

The benchmark is a query set of bounded size: items are collected and shipped
in blocks of ``items_at_once``; each block is one pass over the texts.

Defined cases: null and empty texts are not contaminated; null or empty items
match nothing; items under 5 words are one shingle and match only the same
words; equal items are reported each; ties in similarity go to the earliest
place; null ids and equal rows are allowed, each row by itself; an input
column of the output's name is replaced; empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardsmith.llm.common import SPACE, WordHasher, add_columns, shingle_hashes

SHINGLE = 5
NEAR = 1e-9  # more than the rounding of running sums of weights
WORDS_AT_ONCE = 100_000  # words of texts whose windows are looked up together
SEGMENT = 2048  # windows fingerprinted at a time; their counts fit a processor's cache


def fingerprints(h: np.ndarray, sizes: list[int]):
    """(size, first window, SimHashes) of all windows of the words hashed in ``h``, a segment at a time.

    A bit of a SimHash is set when more than half of the window's words have it.
    """
    widest = max(sizes)
    kind = np.uint8 if widest < 256 else np.uint32
    for lo in range(0, len(h), SEGMENT):
        part = h[lo : lo + SEGMENT + widest - 1]
        # sums over 1, 2, 4 ... words; a window's sum is made of those
        doubled = [np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(kind, copy=False)]
        while 2 << (len(doubled) - 1) <= min(widest, len(part)):
            d, step = doubled[-1], 1 << (len(doubled) - 1)
            doubled.append(d[:-step] + d[step:])
        for size in sizes:
            n = min(len(part) - size + 1, SEGMENT)
            if n <= 0:
                continue
            total, at = None, 0
            for k in range(size.bit_length() - 1, -1, -1):
                if size >> k & 1:
                    total = doubled[k][at : at + n] if total is None else total + doubled[k][at : at + n]
                    at += 1 << k
            yield size, lo, np.packbits(total > size // 2, axis=1, bitorder="little").view(np.uint64)[:, 0]


class Blocks:
    """All fingerprints within a radius of those given, through tables of their blocks."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, self.tables = prints, radius, []
        edges = np.linspace(0, 64, radius + 2).astype(int)
        for lo, hi in zip(edges[:-1], edges[1:]):
            shift, mask = np.uint64(lo), np.uint64((1 << int(hi - lo)) - 1)
            value = ((prints >> shift) & mask).view(np.int64)
            order = np.argsort(value, kind="stable")
            there = None
            if hi - lo <= 20:
                there = np.zeros(1 << int(hi - lo), bool)
                there[value] = True
            self.tables.append((shift, mask, value[order], order, there))

    def pairs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``x``, index into the prints) of the pairs within the radius; a pair may come more than once."""
        left, right = [], []
        for shift, mask, value, order, there in self.tables:
            v = ((x >> shift) & mask).view(np.int64)
            at = np.flatnonzero(there[v]) if there is not None else np.arange(len(x))
            if len(at):
                lo, hi = np.searchsorted(value, v[at], "left"), np.searchsorted(value, v[at], "right")
                n = hi - lo
                i = np.repeat(at, n)
                j = order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                near = np.bitwise_count(x[i] ^ self.prints[j]) <= self.radius
                left.append(i[near])
                right.append(j[near])
        return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.int64), np.empty(0, np.int64))


class Benchmark:
    """Items prepared for the search: probes by window size, shingles and weights."""

    def __init__(self, items: list[str], radius: int, weights: dict[int, float], threshold: float):
        self.weights, self.threshold, self.hasher = weights, threshold, WordHasher()
        self.hashes = [self.hasher(t) for t in items]
        self.lengths = [len(h) for h in self.hashes]
        self.shingles = [Counter(shingle_hashes(h, SHINGLE).tolist()) for h in self.hashes]
        self.totals = [sum(self.weights.get(s, 1.0) * n for s, n in c.items()) for c in self.shingles]
        probes: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, h in enumerate(self.hashes):
            size = min(SHINGLE, len(h))
            prints = np.concatenate([p for _, _, p in fingerprints(h, [size])])
            probes[size] += [(int(prints[i]), k) for i in self.probes(k)]
        self.sizes = sorted(probes)
        self.blocks = {s: Blocks(np.array([p for p, _ in v], np.uint64), radius) for s, v in probes.items()}
        self.item_of = {s: np.array([k for _, k in v]) for s, v in probes.items()}

    def probes(self, k: int) -> list[int]:
        """Windows of item ``k`` whose shingles weigh more than 1 - threshold of all: the heaviest, ties by hash."""
        first: dict[int, int] = {}
        for i, s in enumerate(shingle_hashes(self.hashes[k], SHINGLE).tolist()):
            first.setdefault(s, i)
        weight = {s: self.weights.get(s, 1.0) * n for s, n in self.shingles[k].items()}
        taken, at = 0.0, []
        for s in sorted(first, key=lambda s: (-weight[s], s)):
            if at and taken > (1 - self.threshold) * self.totals[k] + NEAR:
                break
            taken += weight[s]
            at.append(first[s])
        return at

    def similarity(self, window: np.ndarray, k: int) -> float:
        a, b = Counter(shingle_hashes(window, SHINGLE).tolist()), self.shingles[k]
        both = either = 0.0
        for s in a.keys() | b.keys():
            w = self.weights.get(s, 1.0)
            both += w * min(a[s], b[s])
            either += w * max(a[s], b[s])
        return both / either if either else 0.0

    def search(self, texts: list[str | None]) -> list[list[tuple[int, float, int, int]]]:
        """For each text (item, similarity, first word, words) of the items found, their best place; by item."""
        out, held, n = [], [], 0
        for t in texts:
            held.append(self.hasher(t))
            n += len(held[-1])
            if n >= WORDS_AT_ONCE:
                out += self._search(held)
                held, n = [], 0
        return out + self._search(held)

    def _search(self, hashes: list[np.ndarray]) -> list[list[tuple[int, float, int, int]]]:
        prints: dict[int, list] = defaultdict(list)
        for t, h in enumerate(hashes):
            sizes = [s for s in self.sizes if s <= len(h)]
            if sizes:
                for size, lo, p in fingerprints(h, sizes):
                    prints[size].append((t, lo, p))
        places: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for size, parts in prints.items():
            i, j = self.blocks[size].pairs(np.concatenate([p for _, _, p in parts]))
            ends = np.cumsum([len(p) for _, _, p in parts])
            at = np.searchsorted(ends, i, "right")
            first = np.array([lo for _, lo, _ in parts]) - ends + [len(p) for _, _, p in parts]
            text = np.array([t for t, _, _ in parts])
            for t, k, x in zip(text[at].tolist(), self.item_of[size][j].tolist(), (i + first[at]).tolist()):
                places[t][k].add(x)
        return [self._best(h, places[t]) if t in places else [] for t, h in enumerate(hashes)]

    def _best(self, h: np.ndarray, places: dict[int, set[int]]) -> list[tuple[int, float, int, int]]:
        found, shingles = [], shingle_hashes(h, SHINGLE).tolist()
        for k in sorted(places):
            n, best = self.lengths[k], None
            for lo, hi in self._starts(places[k], n):
                for q in self._similar(shingles, k, lo, hi) if n >= SHINGLE else range(lo, hi + 1):
                    first, end = max(q, 0), min(q + n, len(h))
                    s = self.similarity(h[first:end], k)
                    if s >= self.threshold and (best is None or (-s, first) < (-best[0], best[1])):
                        best = (s, first, end - first)
            if best:
                found.append((k, *best))
        return found

    def _starts(self, places: set[int], n: int) -> list[list[int]]:
        """The ranges of starts of all windows of ``n`` words that hold one of the places, from left to right."""
        out: list[list[int]] = []
        for x in sorted(places):
            lo = x - n + min(n, SHINGLE)
            if out and lo <= out[-1][1] + 1:
                out[-1][1] = x
            else:
                out.append([lo, x])
        return out

    def _similar(self, shingles: list[int], k: int, lo: int, hi: int) -> list[int]:
        """The starts from ``lo`` to ``hi`` whose windows may be the most similar ones and reach the threshold, by running sums."""
        of, m = self.shingles[k], self.lengths[k] - SHINGLE + 1
        weights, total = self.weights, self.totals[k]
        region = shingles[max(lo, 0) : max(hi + m, 0)]
        there = Counter(s for s in region if s in of)
        if sum(weights.get(s, 1.0) * min(n, of[s]) for s, n in there.items()) < self.threshold * total - NEAR:
            return []  # too little in common at any of the starts
        has: Counter = Counter()
        mine = both = 0.0
        out, least = [], self.threshold
        for i in range(lo, hi + m):
            if 0 <= i < len(shingles):
                s = shingles[i]
                w = weights.get(s, 1.0)
                mine += w
                if s in of:
                    has[s] += 1
                    both += w if has[s] <= of[s] else 0.0
            q = i - m + 1
            if q < lo:
                continue
            similar = both / (mine + total - both)
            if similar >= least - NEAR:
                out.append((similar, q))
                least = max(least, similar)
            if 0 <= q < len(shingles):
                s = shingles[q]
                w = weights.get(s, 1.0)
                mine -= w
                if s in of:
                    both -= w if has[s] <= of[s] else 0.0
                    has[s] -= 1
        return [q for s, q in out if s >= least - NEAR]


def shingle_weights(benchmark: DataFrame, text_col: str) -> dict[int, float]:
    """One over the number of items of each shingle that more than one item has."""
    hasher = WordHasher()
    found: Counter = Counter()
    for r in benchmark.select(text_col).toLocalIterator():
        found.update(set(shingle_hashes(hasher(r[0]), SHINGLE).tolist()))
    return {s: 1 / n for s, n in found.items() if n > 1}


def contamination(docs: DataFrame, benchmark: DataFrame, radius: int = 3, threshold: float = 0.75, items_at_once: int = 20_000, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``contamination``: an array of (item, similarity, start_word, n_words), by item."""
    spark = docs.sparkSession
    field = T.StructType([T.StructField("item", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("start_word", T.LongType()), T.StructField("n_words", T.LongType())])
    docs = docs.select(*(c for c in docs.columns if c.lower() != "contamination"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    weights = shingle_weights(items, "text")
    blocks = max(1, -(-items.count() // items_at_once))
    parts = []
    for b in range(blocks):
        rows = [(r["item"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == b).sort("item", "text").collect()]
        rows = [r for r in rows if r[1].strip(SPACE)]
        if not rows:
            continue
        shipped = spark.sparkContext.broadcast((rows, weights))  # items_at_once items at most, on average

        def make(shipped=shipped):
            rows, weights = shipped.value
            bench = Benchmark([t for _, t in rows], radius, weights, threshold)

            def search(texts):
                return [[[{"item": rows[k][0], "similarity": s, "start_word": p, "n_words": n} for k, s, p, n in found] for found in bench.search(texts)]]

            return search

        docs = add_columns(docs, make, [text_col], {f"__found_{b}": T.ArrayType(field)})
        parts.append(f"__found_{b}")
    found = F.concat(*parts) if parts else F.array().cast(T.ArrayType(field))
    return docs.withColumn("contamination", F.array_sort(found)).drop(*parts)
