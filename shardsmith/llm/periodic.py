"""Periodic runs: stretches of words that repeat with one period.

A run is a stretch of consecutive words whose smallest period is q (words q
apart are identical), at least ``min_length`` words and 2q long, that no
neighbouring word extends keeping the period.  Words are
``[^\\x20\\x09-\\x0D]+``, case counts, and are numbered from 0.

Method: an online, sparse DP over diagonals.  The text is walked from left to
right; at each place its earlier occurrences give the lags that match there,
the match length of each such lag grows, and a lag that no longer matches
ends its diagonal: if that is long enough, its run is emitted at once.  A
diagonal of lag q with m matching words is a run of q + m words.

So that neither frequent words nor texts that are periodic all over make it
quadratic, the lags go by octaves, from 2^k to 2^(k+1) - 1.  A run of such a
period matches at least ``least`` = max(2^k, min_length - 2^(k+1) + 1) words,
so the DP of an octave moves in steps of half that many words, by the grams
of a step's words: any run holds one whole step.  A step looks back at no more
than one octave of places, so there are at most 2n candidates in an octave and
2n log n in all, whatever the text.  Places within a run of a period up to a
step's size give no candidates among themselves: what matches there has the
smaller period.  The ends of a diagonal are found word by word.

Each document is worked on by itself: one pass over the table, no shuffle.

Defined cases: null, empty and blank texts have no words and no runs; null
ids are allowed; equal rows give equal results; stretches that have several
periods are one run, of the smallest; texts are walked whole; columns of the
input named like an output are replaced, others stay; empty tables give empty
results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shardsmith.llm.common import add_columns, scramble, word_ids

RUN = T.StructType([T.StructField(f, T.LongType()) for f in ("start", "length", "period")])
BASE = 0x9FB21C651E98DF25  # odd, so that it has an inverse


class Grams:
    """Hashes of the grams of one text, of any length, from running sums."""

    def __init__(self, w: np.ndarray):
        n = len(w)
        self.power = np.full(n + 1, BASE, np.uint64)
        self.power[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(scramble(w.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=self.total[1:])

    def __call__(self, size: int, at: np.ndarray) -> np.ndarray:
        """The grams of ``size`` words that begin ``at``, brought to the same power."""
        return (self.total[at + size] - self.total[at]) * self.power[len(self.power) - 1 - at]


def _repeated(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose gram is found twice or more, by gram, then place, and the gram's number for each."""
    order = np.argsort(codes, kind="stable")
    c = codes[order]
    new = np.ones(len(c), bool)
    new[1:] = c[1:] != c[:-1]
    alone = new.copy()
    alone[:-1] &= new[1:]
    return at[order][~alone], (np.cumsum(new) - 1)[~alone]


def _candidates(at: np.ndarray, gram: np.ndarray, step: int, low: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, earlier place) for places on a step's edge, with the same gram and a lag from ``low`` to ``2 * low - 1``."""
    key = gram * (n + 1) + at
    mine = (at % step == 0) & (at >= low)
    p, base = at[mine], gram[mine] * (n + 1)
    first = np.searchsorted(key, base + np.maximum(p - 2 * low + 1, 0))
    count = np.searchsorted(key, base + p - low, side="right") - first
    here = np.repeat(p, count)
    nth = np.arange(len(here)) - np.repeat(np.cumsum(count) - count, count)
    return here, at[np.repeat(first, count) + nth]


def _diagonals(places: list[int], lags: list[int], step: int) -> Iterator[tuple[int, int, int]]:
    """(lag, first, last place) of each diagonal, when it ends; the places ascend."""
    active: dict[int, int] = {}
    i, last = 0, 0
    while i < len(places):
        place = places[i]
        if place != last + step and active:
            yield from ((lag, first, last) for lag, first in active.items())
            active = {}
        now = {}
        while i < len(places) and places[i] == place:
            now[lags[i]] = active.pop(lags[i], place)
            i += 1
        yield from ((lag, first, last) for lag, first in active.items())
        active, last = now, place
    yield from ((lag, first, last) for lag, first in active.items())


def periodic_runs(w: np.ndarray, min_length: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the words ``w`` (numbers, equal for equal words), by start, then period."""
    n = len(w)
    if n < max(2, min_length):
        return []
    grams = Grams(w)
    half = (min_length + 1) // 2  # words that any run's diagonal matches at least
    if half > 1 and not len(_repeated(grams(half, np.arange(n - half + 1)), np.arange(n - half + 1))[0]):
        return []
    found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
    within = np.full(n, n)  # the first word of the widest run around a word, of periods up to a step
    painted: set[tuple[int, int]] = set()
    alive, before, low = np.arange(n), n, 1
    while 2 * low <= n:
        step = (max(low, min_length - 2 * low + 1) + 1) // 2
        if step < before:
            alive = np.arange(n)
        before = step
        alive = alive[alive + step <= n]
        at, gram = _repeated(grams(step, alive), alive)
        alive = np.sort(at)
        for (start, end), period in found.items():
            if period <= step and (start, end) not in painted:
                painted.add((start, end))
                np.minimum(within[start:end], start, out=within[start:end])
        here, there = _candidates(at, gram, step, low, n)
        good = there < within[here + step - 1]
        here, lag = here[good], (here - there)[good]
        order = np.lexsort((lag, here))
        for q, first, last in _diagonals(here[order].tolist(), lag[order].tolist(), step):
            left, right = max(q, first - step), min(n, last + 2 * step)
            edge = np.flatnonzero(np.diff(np.concatenate(([False], w[left:right] == w[left - q : right - q], [False])).astype(np.int8)))
            for a, b in zip((edge[::2] + left).tolist(), (edge[1::2] + left).tolist()):
                # one that goes on beyond its first or last step has a smaller period
                if b - a >= max(q, min_length - q) and not (a == left > q) and not (b == right < n):
                    found[a - q, b] = min(q, found.get((a - q, b), q))
        if not len(alive):  # no gram of a step is found twice, so no longer one is
            break
        low *= 2
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay if all but the first period of each run goes."""
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:-1]) == 0


def collapse_runs(docs: DataFrame, min_length: int = 12, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``: the words
    that stay, joined by one space."""

    def make():
        def one(text: str | None):
            ws = text.encode().split() if text else []
            n, runs = len(ws), periodic_runs(word_ids(ws), min_length)
            if runs:
                ws = [x for x, stays in zip(ws, collapse(n, runs).tolist()) if stays]
            return n, [dict(zip(RUN.names, r)) for r in runs], b" ".join(ws).decode()

        return lambda texts: list(zip(*map(one, texts)))

    return add_columns(docs, make, [text_col], {"n_words": T.LongType(), "runs": T.ArrayType(RUN), "collapsed": T.StringType()})
