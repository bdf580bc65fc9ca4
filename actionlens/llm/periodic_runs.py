"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch of words with smallest period q that holds at least two periods.  All
of them are found exactly, per document, at the dyadic scales t = 1, 2, 4, ...:

* *Names.*  Stretches of 2**k words get a number each, equal for equal stretches of a document
  (doubling: the number of a pair of numbers).  Stretches found once get none, and only numbered
  ones are paired further, so ordinary prose costs two or three levels.
* *Synchronising set.*  A position belongs to the set of scale t when the smallest hash among the
  t-word stretches that begin in [i, i + t] stands at either end of it; stretches of period t/3 or
  less take no part.  Positions with equal contexts of 2t words are chosen alike, and every t
  positions in a row hold one unless their 3t - 1 words have a period of t/3 or less.
* *Proposals.*  Two chosen positions with equal contexts at a distance in [3t - 1, 6t - 1) propose
  that distance as period.  Equal contexts lie more than t/3 apart, so each has a bounded number of
  partners.  Where the set is empty the words of a whole period are a highly periodic region; two
  such regions that touch propose the periods at which their phases agree.  Period 1 is read off
  equal neighbours.
* *Check.*  Every proposal is extended to both sides by the names (longest level first) and kept
  when it holds two periods; of equal stretches the smallest period counts.

Work is linear in the words times the levels; memory is four bytes a word and level of the texts
handled at once (about two megabytes of text, or one longer text alone).

Defined results: null and empty texts and those without words have no run and an empty collapsed
text; repeated rows and rows without doc_id give a row each; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from actionlens.llm.common import documents
from actionlens.llm.textops import SLICE_BYTES, mix

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Names:
    """Numbers of the stretches of 2**k words (-1: found once) of a sequence of word numbers."""

    def __init__(self, word: np.ndarray):
        n = len(word)
        count = np.bincount(word) if n else np.zeros(0, int)
        self.n, self.level = n, [np.where(count[word] > 1, word, -1).astype(np.int32) if n else np.zeros(0, np.int32)]
        while 2 << (len(self.level) - 1) <= n:
            low, half = self.level[-1], 1 << (len(self.level) - 1)
            i = np.flatnonzero(low[:n - half] >= 0)
            i = i[low[i + half] >= 0]
            if not len(i):
                break
            _, inverse, count = np.unique(low[i].astype(np.int64) << 32 | low[i + half], return_inverse=True, return_counts=True)
            again = count[inverse] > 1
            if not again.any():
                break
            up = np.full(n, -1, np.int32)
            up[i[again]] = inverse[again]
            self.level.append(up)

    def _same(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        size, name = 1 << k, self.level[k]
        ok = (a >= 0) & (b >= 0) & (a + size <= self.n) & (b + size <= self.n)
        x = name[np.where(ok, a, 0)]
        return ok & (x >= 0) & (x == name[np.where(ok, b, 0)])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from ``a`` and from ``b`` on."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            far += self._same(k, a + far, b + far).astype(np.int64) << k
        return far

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words before ``a`` and before ``b``."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            far += self._same(k, a - far - (1 << k), b - far - (1 << k)).astype(np.int64) << k
        return far


def _extended(names: Names, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the stretches of at least two periods around the proposals, each once."""
    left, right = names.left(at, at + period), names.right(at, at + period)
    good = left + right >= period
    found = np.unique(np.stack([at - left, at + period + right, period], 1)[good], axis=0)
    return found[:, 0], found[:, 1], found[:, 2]


def _covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of the positions lie in one of the stretches [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step[:n]) > 0


def _synchronising(names: Names, k: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Chosen positions of scale 2**k whose context of 2**(k + 1) words is found again; the runs of smaller periods are known."""
    t, n = 1 << k, names.n
    small = (3 * period <= t) & (end - start >= t)
    hashes = mix(names.level[k].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)) >> np.uint64(1)
    hashes[_covered(n, start[small], end[small] - t + 1)] = _NONE
    low = hashes
    for j in range(k):                               # smallest of 2**(j + 1) in a row
        low = np.minimum(low, np.r_[low[1 << j:], np.full(min(n, 1 << j), _NONE, np.uint64)][:n])
    i = np.flatnonzero(names.level[k + 1] >= 0)      # so i + t is a position too
    least = np.minimum(low[i], low[i + 1])           # of t + 1 in a row
    return i[(least != _NONE) & ((least == hashes[i]) | (least == hashes[i + t]))]


def _equal_contexts(context: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of chosen positions with the same context at a distance in [low, high)."""
    order = np.lexsort((at, context))
    context, at = context[order], at[order]
    first, apart = [], []
    live, step = np.arange(len(at)), 1
    while len(live):
        live = live[live + step < len(at)]
        gap = at[np.minimum(live + step, len(at) - 1)] - at[live]
        near = (context[np.minimum(live + step, len(at) - 1)] == context[live]) & (gap < high)
        live, gap = live[near], gap[near]
        first.append(at[live[gap >= low]])
        apart.append(gap[gap >= low])
        step += 1
    p, d = (np.concatenate(first), np.concatenate(apart)) if first else (np.zeros(0, np.int64),) * 2
    return p, d


def _one_of_a_chain(at: np.ndarray, period: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals of one period whose equal contexts touch lie in one stretch: the first of each chain."""
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    head = np.r_[True, (period[1:] != period[:-1]) | (at[1:] - at[:-1] > reach)] if len(at) else np.zeros(0, bool)
    return at[head], period[head]


def _region_proposals(names: Names, t: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proposals of periods in [3t - 1, 6t - 1) from neighbouring regions of one smaller period q <= t/3 that touch."""
    large = (3 * period <= t) & (end - start >= 3 * t - 1)
    order = np.lexsort((start[large], period[large]))
    a, b, q = start[large][order], end[large][order], period[large][order]
    at, proposed = [], []
    for i in np.flatnonzero((q[1:] == q[:-1]) & (a[1:] <= b[:-1])):
        r, a1, b1, a2, b2 = int(q[i]), int(a[i]), int(b[i]), int(a[i + 1]), int(b[i + 1])
        shift = np.arange(r)
        same = np.flatnonzero(names.right(np.full(r, a1), a2 + shift) >= r)
        if not len(same):
            continue
        phase = (a2 + int(same[0]) - a1) % r
        p = np.arange(3 * t - 1 + (phase - (3 * t - 1)) % r, min(6 * t - 1, (b2 - a1) // 2 + 1), r)
        x = np.maximum(a1, a2 - p)
        ok = x < np.minimum(b1, b2 - p)
        at.append(x[ok])
        proposed.append(p[ok])
    return (np.concatenate(at), np.concatenate(proposed)) if at else (np.zeros(0, np.int64),) * 2


def _smallest(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each stretch once, with its smallest period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    head = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
    return start[head], end[head], period[head]


def all_runs(word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of every run of at least two periods, by start, then period."""
    names, n = Names(word), len(word)
    same = np.r_[False, word[1:] == word[:-1], False] if n else np.zeros(1, bool)
    start = np.flatnonzero(same[1:] & ~same[:-1])
    end = np.flatnonzero(same[:-1] & ~same[1:]) + 1
    period = np.ones(len(start), np.int64)
    for k in range(len(names.level) - 1):
        t = 1 << k
        chosen = _synchronising(names, k, start, end, period)
        at, p = _equal_contexts(names.level[k + 1][chosen], chosen, max(2, 3 * t - 1), 6 * t - 1)
        at, p = _one_of_a_chain(at, p, 2 * t)
        at2, p2 = _region_proposals(names, t, start, end, period)
        s, e, p = _extended(names, np.r_[at, at2], np.r_[p, p2])
        start, end, period = _smallest(np.r_[start, s], np.r_[end, e], np.r_[period, p])
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words, no number in two texts, and where each text begins."""
    out, sizes, used = [], [0], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
        out.append(ids + used)
        used += len(seen)
        sizes.append(len(words))
    return np.concatenate(out), np.cumsum(sizes)


def _slice_rows(texts: list[list[bytes]], min_length: int, min_periods: int) -> tuple[list, list]:
    """Runs and collapsed text of every text; texts are joined to one sequence in which no stretch over a border is found twice."""
    word, first = _numbered(texts)
    start, end, period = all_runs(word)
    long = end - start >= np.maximum(min_length, min_periods * period)
    start, end, period = start[long], end[long], period[long]
    row = np.searchsorted(first, start, "right") - 1
    gone = _covered(len(word), start + period, end)
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    runs, collapsed = [], []
    for d, words in enumerate(texts):
        mine = slice(cut[d], cut[d + 1])
        runs.append([{"start": int(s), "length": int(m), "period": int(p)} for s, m, p in zip(start[mine] - first[d], (end - start)[mine], period[mine])])
        if runs[-1]:
            words = [w for w, g in zip(words, gone[first[d]:first[d + 1]].tolist()) if not g]
        collapsed.append(b" ".join(words))
    return runs, collapsed


def _batches(batches: Iterator[pa.RecordBatch], min_length: int, min_periods: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc, text = batch.column(0), batch.column(1).cast(pa.large_binary())
        a = 0
        while a < len(text):
            texts, size, b = [], 0, a
            while b < len(text) and (b == a or size < SLICE_BYTES):
                whole = text[b].as_py() or b""
                size += len(whole)
                texts.append(whole.split())          # splits at 0x20 and 0x09-0x0D
                b += 1
            runs, collapsed = _slice_rows(texts, min_length, min_periods)
            yield pa.RecordBatch.from_arrays([doc.slice(a, b - a), pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])
            a = b


def periodic_runs(docs: DataFrame, min_length: int = 12, min_periods: int = 2) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: the runs of at least ``min_length`` words and
    ``min_periods`` (2 or more) periods by start and period, and the text's words without what a run
    repeats after its first period, joined by one space."""
    if min_periods < 2:
        raise ValueError("a run holds at least two periods")
    return documents(docs).mapInArrow(lambda batches: _batches(batches, min_length, min_periods), SCHEMA)
