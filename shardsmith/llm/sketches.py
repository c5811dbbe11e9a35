"""Fast similarity sketches and bitmaps of sets of 64-bit hashes (see :mod:`shardsmith.llm.similarity` for the method)."""

from __future__ import annotations

import math

import numpy as np

from shardsmith.llm.common import scramble

COORDS = 210
BITMAP = 1024  # bits of a set's bitmap
AT_ONCE = 1 << 20  # shingles that are sketched together
SIGMAS = 5.5  # of the count of coordinates in which a link agrees
EMPTY = np.uint64(2**64 - 1)
SEEDS = scramble(np.arange(101, 101 + 2 * COORDS, dtype=np.uint64))
LOW = np.uint64(2**32 - 1)


def _throw(x: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the value of each shingle in round i."""
    h = scramble(x ^ SEEDS[i])
    return ((h >> np.uint64(32)) * np.uint64(COORDS) >> np.uint64(32)).astype(np.int64), (h & LOW) | np.uint64(i << 32)


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``COORDS`` values for each of the sets, none of which is empty."""
    size = np.array([len(s) for s in sets], np.int64)
    x, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    out = np.full((len(sets), COORDS), EMPTY, np.uint64)
    flat = out.reshape(-1)
    open_ = np.arange(len(sets))
    for i in range(COORDS):
        at, value = _throw(x, i)
        np.minimum.at(flat, owner * COORDS + at, value)
        still = (out[open_] == EMPTY).any(axis=1)
        if not still.all():
            open_ = open_[still]
            if not len(open_):
                return out
            stays = np.zeros(len(sets), bool)
            stays[open_] = True
            x, owner = x[stays[owner]], owner[stays[owner]]
    for k in open_:  # sets of a few shingles
        missing = np.flatnonzero(out[k] == EMPTY)
        h = scramble(sets[k][:, None] ^ SEEDS[COORDS + missing])
        out[k, missing] = (h & LOW).min(axis=0) | ((COORDS + missing).astype(np.uint64) << np.uint64(32))
    return out


def prints(sketches: np.ndarray) -> np.ndarray:
    """A byte of each coordinate."""
    return (scramble(sketches) >> np.uint64(56)).astype(np.uint8)


def least_agreement(num: int, den: int) -> int:
    """The coordinates in which the sketches of a link agree, but for ``SIGMAS`` deviations."""
    p = num / den
    return max(0, math.floor(COORDS * p - SIGMAS * math.sqrt(COORDS * p * (1 - p))))


def bitmap(s: np.ndarray) -> bytes:
    """``BITMAP`` bits, of which each shingle turns over one: bitmaps differ in at most as many bits as sets in shingles."""
    return np.packbits(np.bincount((s >> np.uint64(20)).astype(np.int64) % BITMAP, minlength=BITMAP) & 1).tobytes()


def bitmaps_fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of those bitmaps and sizes can be alike enough (exact: no link is ruled out)."""
    both = (n + m - np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1, dtype=np.int64)) // 2
    return den * both >= num * (n + m - both)


def may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: int, num: int, den: int) -> np.ndarray:
    """Whether sets of those prints (bitmap, then sketch) can be alike enough: they share at most half of what their
    sizes exceed the bits in which their bitmaps differ (exact, but it says little of long sets), and their sketches
    agree in ``least`` coordinates (true of a link but with probability 2e-8)."""
    cut = BITMAP // 8
    near = bitmaps_fit(x[:, :cut], y[:, :cut], n, m, num, den)
    near[near] = (x[near, cut:] == y[near, cut:]).sum(axis=1) >= least
    return near


def _portions(sets: list[np.ndarray]):
    """Consecutive slices of about ``AT_ONCE`` shingles, a set or more each."""
    start = total = 0
    for i, s in enumerate(sets):
        if total and total + len(s) > AT_ONCE:
            yield slice(start, i)
            start, total = i, 0
        total += len(s)
    if start < len(sets):
        yield slice(start, len(sets))


def sketched(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of sets that may be empty; theirs is empty too."""
    out = np.full((len(sets), COORDS), EMPTY, np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    for part in _portions([sets[i] for i in full]):
        out[full[part]] = sketch([sets[i] for i in full[part]])
    return out
