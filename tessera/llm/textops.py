"""Vectorised text helpers used inside Spark tasks.

A task sees Arrow batches of ``(doc_id, text)``.  The functions here work on the
UTF-8 bytes of a slice of such a batch with numpy, so no Python code runs per
word: word bounds come from a byte table, word hashes from prefix sums of a
polynomial hash, window hashes from prefix sums over word hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D, i.e. the
pattern ``[^\\x20\\x09-\\x0D]+`` (none of those bytes occurs inside a multi-byte
character).  A null text counts as an empty one.
"""
from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # text bytes handled at once; a single longer text is a slice of its own
_BYTE_MULT = 0x9E3779B97F4A7C15  # odd: invertible modulo 2**64
_WORD_MULT = 0xD1B54A32D192ED03
_M64 = (1 << 64) - 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64 (every output bit depends on every input bit)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE_MULT))


def worker_cache(name: str) -> dict:
    """A dictionary that a Python worker keeps between tasks.

    Functions travel by value, so a module-level dictionary would be new in
    every task, and the old ones would wait for the garbage collector.
    """
    kept = sys.modules.setdefault("_tessera_worker_cache", types.ModuleType("_tessera_worker_cache"))
    return kept.__dict__.setdefault(name, {})


def _powers(mult: int, n: int) -> np.ndarray:
    """The first ``n`` powers; the longest run asked for so far is kept, up to that of an ordinary slice."""
    kept = worker_cache("powers")
    if mult in kept and len(kept[mult]) >= n:
        return kept[mult][:n]
    out = np.full(n, mult, np.uint64)
    out[0] = 1
    out = np.multiply.accumulate(out)
    if n <= 4 * SLICE_BYTES:
        kept[mult] = out
    return out


def _power_pair(mult: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(n, SLICE_BYTES + 1)
    return _powers(mult, size)[:n], _powers(pow(mult, -1, 1 << 64), size)[:n]


class RangeHash:
    """Hash of any range ``[start, end)`` of a value sequence in O(1) after one prefix sum."""

    def __init__(self, values: np.ndarray, mult: int):
        n = len(values)
        up, self._down = _power_pair(mult, n + 1)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self._sum[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sum[end] - self._sum[start]) * self._down[start]
        return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


class Slice:
    """Some consecutive documents of a batch: bytes, document offsets and (lazily) words."""

    def __init__(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray):
        self.ids, self.data, self.offsets = ids, data, offsets
        self.n_docs = len(offsets) - 1
        self._bytes: RangeHash | None = None

    def split_words(self) -> None:
        data, offsets = self.data, self.offsets
        n = len(data)
        in_word = ~IS_SPACE[data]
        before = np.zeros(n, bool)
        before[1:] = in_word[:-1]
        inner = offsets[offsets < n]
        before[inner] = False
        after = np.zeros(n, bool)
        after[:-1] = in_word[1:]
        after[inner[inner > 0] - 1] = False
        self.in_word = in_word
        self.starts = np.flatnonzero(in_word & ~before)
        self.ends = np.flatnonzero(in_word & ~after) + 1
        #: words of document d are first[d] .. first[d + 1]
        self.first = np.searchsorted(self.starts, offsets)
        self.n_words = np.diff(self.first)
        self.word_doc = np.repeat(np.arange(self.n_docs), self.n_words)

    @property
    def byte_hash(self) -> RangeHash:
        if self._bytes is None:
            self._bytes = RangeHash(_BYTE_VALUE[self.data], _BYTE_MULT)
        return self._bytes

    def word_hashes(self) -> np.ndarray:
        return self.byte_hash(self.starts, self.ends)

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of ``k`` words that lies in one document."""
        total = len(hashes)
        if total < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(total - k + 1)
        at = at[self.word_doc[at] == self.word_doc[at + k - 1]]
        return at, RangeHash(hashes, _WORD_MULT)(at, at + k)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, start byte, end byte) of every \\n-separated line; an empty text has one empty line."""
        cut = np.flatnonzero(self.data == 10)
        doc_of_cut = np.searchsorted(self.offsets, cut, side="right") - 1
        start = np.concatenate([self.offsets[:-1], cut + 1])
        end = np.concatenate([cut, self.offsets[1:]])
        doc = np.concatenate([np.arange(self.n_docs), doc_of_cut])
        doc_end = np.concatenate([doc_of_cut, np.arange(self.n_docs)])
        a = np.lexsort((start, doc))
        b = np.lexsort((end, doc_end))
        return doc[a], start[a], end[b]

    def per_doc_sum(self, values: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array in each document."""
        c = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=c[1:])
        return c[self.offsets[1:]] - c[self.offsets[:-1]]

    def text(self, doc: int) -> bytes:
        return self.data[self.offsets[doc]:self.offsets[doc + 1]].tobytes()


def slices(ids: pa.Array, texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut one batch into slices of about ``limit`` text bytes."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = texts.buffers()[2] if n else None
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        to = min(to, n)
        lo, hi = int(offs[at]), int(offs[to])
        yield Slice(ids.slice(at, to - at), data[lo:hi], (offs[at:to + 1] - lo).astype(np.int64))
        at = to


def text_slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Slices of batches whose first column is an id and whose second is the text."""
    for batch in batches:
        if batch.num_rows:
            yield from slices(batch.column(0), batch.column(1), limit)


def keyed_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.Array, Slice]]:
    """Slices of a batch (id, text, key), each with its part of the key column."""
    at = 0
    for s in slices(batch.column(0), batch.column(1), limit):
        yield batch.column(2).slice(at, s.n_docs), s
        at += s.n_docs


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key occurs twice or more, key occurred earlier) for each element."""
    n = len(keys)
    again, later = np.zeros(n, bool), np.zeros(n, bool)
    if n > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        later[order[1:]] = same
        again[order[1:]] = same
        again[order[:-1]] |= same
    return again, later


def cover(total: int, at: np.ndarray, k: int) -> np.ndarray:
    """Positions of ``0 .. total`` covered by a run of ``k`` that starts at one of ``at``."""
    step = np.bincount(at, minlength=total + 1) - np.bincount(np.minimum(at + k, total), minlength=total + 1)
    return np.cumsum(step[:total]) > 0
