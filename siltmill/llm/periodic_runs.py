"""Periodic runs of words by a harmonic grid.

A run of period p keeps words p apart identical over a stretch that is longer than the grid's step for p, so one point
of the grid 0, step, 2 * step, ... lies in it. All (period, grid point) pairs of a text are extended to both sides at
once: a binary search for the longest common extension by prefix hashes. The runs found so are verified word by word and
deduplicated to their smallest period; where a verification fails, the text is searched again with another base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = "struct<start:long,length:long,period:long>"
#: A run has this many words, and this many times its period, at least.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Pairs of the grid that are looked at together: what a text needs beside itself, however long it is.
PAIRS = 1 << 20
_PRIME = (1 << 31) - 1


class Hashes:
    """Prefix hashes of word numbers modulo a prime; products stay below 2^62."""

    def __init__(self, ids: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1 << 20, _PRIME - 1))
        n = len(ids)
        powers = np.ones(n + 1, np.int64)
        done, step = 1, base
        while done <= n:  # doubles the part that is filled; step is base to the power done
            more = min(done, n + 1 - done)
            powers[done : done + more] = powers[:more] * step % _PRIME
            done, step = done + more, step * step % _PRIME
        marks = rng.integers(1, _PRIME, int(ids.max()) + 1)[ids]
        self.powers, self.sums = powers, np.zeros(n + 1, np.int64)
        self.sums[1:] = np.cumsum(marks * powers[:n] % _PRIME) % _PRIME

    def same(self, at: np.ndarray, period: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of length from at and from at + period have one hash."""
        s, to = self.sums, at + length
        near, far = s[to] - s[at], s[to + period] - s[at + period]
        return (near % _PRIME * self.powers[period] - far) % _PRIME == 0

    def ahead(self, at: np.ndarray, period: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The greatest length, up to most, for which the stretches from at and from at + period agree."""
        return self._search(lambda x: self.same(at, period, x), most)

    def behind(self, at: np.ndarray, period: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The same for the stretches that end before at and before at + period."""
        return self._search(lambda x: self.same(at - x, period, x), most)

    @staticmethod
    def _search(agrees, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            half = (low + high + 1) >> 1
            good = agrees(half)
            low, high = np.where(good, half, low), np.where(good, high, half - 1)
        return low


def _grids(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grid points, periods) of n words, at most about PAIRS at a time."""
    periods = np.arange(1, n // LEAST_TIMES + 1)
    steps = np.maximum(LEAST_WORDS, LEAST_TIMES * periods) - periods  # of places whose word comes again a period later
    counts = (n - periods) // steps
    part = np.cumsum(counts) // PAIRS
    for k in range(int(part[-1]) + 1 if len(part) else 0):
        p, c, step = (x[part == k] for x in (periods, counts, steps))
        nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        yield (nth + 1) * np.repeat(step, c) - 1, np.repeat(p, c)


def _candidates(ids: np.ndarray, hashes: Hashes) -> np.ndarray:
    """Distinct rows (start, end, period) of stretches that are long enough, by their hashes."""
    n, found, known = len(ids), [], []
    for at, p in _grids(n):
        new = ids[at] == ids[at + p]
        for s, e, q in known:  # has period p as well, and there no other stretch does
            new &= (at < s) | (at + p >= e) | (p % q != 0) | (LEAST_TIMES * p > e - s)
        hit = np.flatnonzero(new)
        if not len(hit):
            continue
        at, p = at[hit], p[hit]
        # a stretch around a point reaches half of itself to one side at least
        half = (np.maximum(LEAST_WORDS, LEAST_TIMES * p) - p) // 2
        right, left = np.minimum(half, n - p - at), np.minimum(half, at)
        hit = np.flatnonzero(((right == half) & hashes.same(at, p, right)) | ((left == half) & hashes.same(at - left, p, left)))
        if not len(hit):
            continue
        at, p = at[hit], p[hit]
        start, end = at - hashes.behind(at, p, at), at + p + hashes.ahead(at, p, n - p - at)
        long = end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * p)
        found.append(np.unique(np.stack([start[long], end[long], p[long]], axis=1), axis=0))
        if len(at) > len(found[-1]) > 0:
            known += [max(found[-1].tolist(), key=lambda x: (x[1] - x[0], -x[2]))]
    return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)


def _maximal(ids: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether the words from start to end have the period and no neighbour keeps it."""
    if not np.array_equal(ids[start : end - period], ids[start + period : end]):
        return False
    return (start == 0 or ids[start - 1] != ids[start - 1 + period]) and (end == len(ids) or ids[end] != ids[end - period])


def runs_of(ids: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the runs in a sequence of word numbers, by start, then period.

    A stretch of smallest period q is found for multiples of q too; two periods that fit in it twice have their greatest
    common divisor as a period, so whatever else is found for it must be a multiple of q.
    """
    ids = np.asarray(ids, np.int64)
    for seed in range(1 << 30):
        rows = _candidates(ids, Hashes(ids, seed)) if len(ids) >= LEAST_WORDS else np.empty((0, 3), np.int64)
        if not len(rows):
            return rows
        first = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
        smallest = np.repeat(rows[first, 2], np.diff(np.append(first, len(rows))))
        if not (rows[:, 2] % smallest).any() and all(_maximal(ids, *x) for x in rows[first].tolist()):
            start, end, period = rows[first].T
            out = np.stack([start, end - start, period], axis=1)
            return out[np.lexsort((out[:, 2], out[:, 0]))]
    raise AssertionError("no base tells the words apart")


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    start, length, period = runs.T
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def examine(text: bytes | None) -> tuple[int, list[tuple[int, int, int]], bytes]:
    """Words, runs and the collapsed text of a whole text in UTF-8."""
    words = (text or b"").split()  # of bytes: splits at ASCII white space and nowhere else
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    runs = runs_of(ids)
    return len(words), [tuple(x) for x in runs.tolist()], collapse(words, runs)


def _examined(texts: pd.Series) -> pd.DataFrame:
    rows = [examine(x) for x in texts]
    runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for _, r, _ in rows]
    return pd.DataFrame({"n_words": [r[0] for r in rows], "runs": runs, "collapsed": [r[2] for r in rows]})


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs (array of start, length, period by start, then period) and collapsed (the
    words joined by one space without those that a run repeats).

    A run is a stretch of words of smallest period q, 4 * q and 6 words long at least, that no neighbouring word
    extends. A null or empty text has no words, no runs and an empty collapsed text; repeated rows and ids give repeated
    rows, an empty table none; other columns, whatever their names, are ignored. Every text is read whole: n words take
    time n log(n) squared and memory in proportion to n. Nothing is shuffled.
    """
    seen = docs.select(F.col(id_col), F.pandas_udf(_examined, f"n_words long, runs array<{RUN}>, collapsed binary")(F.col(text_col).cast("binary")).alias("__r"))
    return seen.select(id_col, "__r.n_words", "__r.runs", F.col("__r.collapsed").cast("string").alias("collapsed"))
