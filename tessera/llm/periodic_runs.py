"""Periodic runs of words: branching tandem repeats from an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) and at least ``max(min_length, 2 * q)`` words that no neighbouring
word extends keeping period q.  Documents are independent rows; a task works on
slices of some megabytes, a longer document being a slice of its own.

1. The suffix array of a slice comes from prefix doubling that sorts only the
   suffixes that still share a rank; words carry their document's number, so
   suffixes of different documents never agree.  The longest common prefixes
   (LCP) of neighbours come from range hashes by bisection.
2. Each LCP value splits its interval in two; the suffixes of the smaller side are
   tested: suffix i of an interval of depth d has a square of period d behind it
   (or before it) if i + d (or i - d) lies in the same interval, that is if its
   inverse suffix array entry is within the interval's bounds, and the square is
   branching if the word behind it breaks the period.  Intervals are bounds in
   arrays; no tree is built.  All tests of a slice together are O(n log n).
3. A branching square ends where its run ends.  It is rotated to the left as far
   as the period holds (by powers of two, on range hashes), which gives the run's
   start; squares of one run meet in the same stretch, whose least period counts.

Cases: a null or empty text has no words, no runs and an empty collapsed text; a
repeated row gives a repeated result; an empty table gives an empty result; other
columns are ignored.  Words are compared by 64-bit hashes.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.textops import RangeHash, Slice, _WORD_MULT, slices

MIN_LENGTH = 12
SLICE_BYTES = 1 << 20
TESTS_AT_ONCE = 1 << 20


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, its inverse) of ``symbols``, by prefix doubling over the suffixes that still share a rank."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    first = np.append(True, np.diff(rank[order]) > 0) if n else np.zeros(0, bool)
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]  # a rank is the first place of its group
    size = 1
    while True:
        same = np.append(first, True)
        places = np.flatnonzero(~(same[:-1] & same[1:]))  # places of groups of two or more
        if not len(places):
            return order, rank
        who = order[places]
        behind = np.where(who + size < n, rank[np.minimum(who + size, n - 1)] + 1, 0)
        by = np.lexsort((behind, rank[who]))
        who, behind = who[by], behind[by]
        order[places] = who
        old = rank[who]
        new = np.append(True, (old[1:] != old[:-1]) | (behind[1:] != behind[:-1]))
        rank[who] = places[np.flatnonzero(new)[np.cumsum(new) - 1]]
        first[places] = new
        size *= 2


class Stretch:
    """Range hashes of a word sequence: how far two places agree to the right or to the left."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self._hash = RangeHash(words, _WORD_MULT)

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, sign: int) -> np.ndarray:
        done = np.zeros(len(a), np.int64)
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            can = np.flatnonzero(done + step <= most)
            x, y = a[can] + sign * done[can], b[can] + sign * done[can]
            same = self._hash(x, x + step) == self._hash(y, y + step) if sign > 0 else self._hash(x - step, x) == self._hash(y - step, y)
            done[can[same]] += step
            step //= 2
        return done

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from ``a`` and from ``b`` on that agree."""
        return self._agree(a, b, self.n - np.maximum(a, b), 1)

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words before ``a`` and before ``b`` that agree."""
        return self._agree(a, b, np.minimum(a, b), -1)


def lcp_splits(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each place b with lcp[b] > 0: (b, depth, interval from, interval to, split from): the interval's suffixes are
    ``from .. to``; b halves ``split from .. to`` in the sides before b and from b on."""
    values = np.append(lcp, -1).tolist()
    lower, same, upper = ([0] * len(values) for _ in range(3))
    stack: list[int] = []
    for b, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            upper[stack.pop()] = b
        if stack:
            top = stack[-1]
            same[b] = top
            lower[b] = lower[top] if values[top] == v else top
        stack.append(b)
    b = np.flatnonzero(lcp > 0)
    return b, lcp[b], np.array(lower)[b], np.array(upper)[b] - 1, np.array(same)[b]


def branching_squares(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every branching tandem repeat of a sequence."""
    none = np.zeros(0, np.int64)
    n = len(words)
    if n < 2:
        return none, none
    order, rank = suffix_array(words)
    stretch = Stretch(words)
    lcp = np.zeros(n, np.int64)
    near = np.flatnonzero(words[order[1:]] == words[order[:-1]]) + 1
    lcp[near] = stretch.right(order[near - 1], order[near])
    b, depth, low, high, split = lcp_splits(lcp)
    left_smaller = b - split <= high + 1 - b
    first = np.where(left_smaller, split, b)
    size = np.where(left_smaller, b - split, high + 1 - b)
    ends = np.cumsum(size)
    starts, periods = [none], [none]
    at = 0
    while at < len(b):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TESTS_AT_ONCE, side="right")))
        mine = np.repeat(np.arange(at, to), size[at:to])
        base = np.repeat(ends[at:to] - size[at:to], size[at:to])
        i = order[first[mine] + np.arange(len(mine)) + (ends[at] - size[at]) - base]
        d, lo, hi = depth[mine], low[mine], high[mine]
        for a in (i, i - d):  # the square begins at the suffix, or a period before it
            ok = (a >= 0) & (a + d < n)
            other = np.where(ok, np.where(a == i, a + d, a), 0)
            ok &= (rank[other] >= lo) & (rank[other] <= hi)
            a, p = a[ok], d[ok]
            breaks = (a + 2 * p >= n) | (words[np.minimum(a + 2 * p, n - 1)] != words[a + p])
            starts.append(a[breaks])
            periods.append(p[breaks])
        at = to
    return np.concatenate(starts), np.concatenate(periods)


def runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of a sequence, by start, then period."""
    start, period = branching_squares(words)
    end = start + 2 * period
    start = start - Stretch(words).left(start, start + period) if len(start) else start
    long = end - start >= np.maximum(min_length, 2 * period)
    start, end, period = start[long], end[long], period[long]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    least = np.append(True, (np.diff(start) > 0) | (np.diff(end) > 0)) if len(by) else np.zeros(0, bool)
    start, end, period = start[least], end[least], period[least]
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def _detect(min_length: int):
    def detect(batches):
        for batch in batches:
            for s in slices(batch.column(0), batch.column(1), SLICE_BYTES):
                yield _slice_runs(s, min_length)
    return detect


def _slice_runs(s: Slice, min_length: int) -> pa.RecordBatch:
    s.split_words()
    total = len(s.starts)
    hashes = s.word_hashes() if total else np.zeros(0, np.uint64)
    own = hashes ^ (s.word_doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407)  # a word of another document is another word
    start, length, period = runs(own, min_length)
    doc = s.word_doc[start]
    step = np.bincount(start + period, minlength=total + 1) - np.bincount(start + length, minlength=total + 1)
    kept = np.cumsum(step[:total]) == 0
    raw = s.data.tobytes()
    texts = []
    for d in range(s.n_docs):
        mine = np.flatnonzero(kept[s.first[d]:s.first[d + 1]]) + s.first[d]
        texts.append(b" ".join([raw[x:y] for x, y in zip(s.starts[mine].tolist(), s.ends[mine].tolist(), strict=True)]).decode())
    found = pa.StructArray.from_arrays([pa.array(start - s.first[doc]), pa.array(length), pa.array(period)], names=["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(s.n_docs + 1)).astype(np.int32)), found)
    return pa.RecordBatch.from_arrays([s.ids, pa.array(s.n_words.astype(np.int64)), lists, pa.array(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, ``runs`` (start, length, period; by start, then period) and the text
    ``collapsed``: its words, joined by one space, without those that a run contains behind its first period."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return texts.mapInArrow(_detect(min_length), "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
