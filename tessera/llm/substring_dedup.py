"""Substring dedup: suffix automata over shards of the repeated reference text.

A window is ``WINDOW`` consecutive words of a document.  Every word covered by
a window whose words also start earlier (smaller doc_id, or the same document
and an earlier place) is removed; windows are judged on the input.

The reference is the corpus itself, so one automaton of it cannot be sent to
every task.  The work is cut so that each automaton is small and every window
meets the only automaton that can know it:

1. A window's anchor is its smallest hashed ``GRAM``-word gram; equal windows
   have equal anchors.  A segment is a run of windows around one anchor place
   (at most ``WINDOW - GRAM + 1`` of them).  Anchors seen once in the corpus
   cannot be in a repeated window and end here.
2. Equal segments are one content, kept with its first place.  Contents are
   dealt to shards by anchor, about ``SHARD_CONTENTS`` to a shard.
3. A shard streams its contents, by first place, through a suffix automaton of
   the words before them: the matching statistics tell, at every word, whether
   the last ``WINDOW`` words stand earlier.  What is new extends the automaton.
   (Equal windows have their anchor at the same word, so none is twice in a segment.)
4. An anchor with more than ``HOT_CONTENTS`` contents would make a shard grow
   without limit; its windows are grouped by their own hash instead, which
   spreads them, combines equal ones before the shuffle and gives the same places.
5. At its first place a content loses the windows found by then, at every other
   place all of its windows stand earlier; one bit mask per content goes back to
   the occurrences, and each document drops what its windows cover (the spans are
   maximal unions of such windows).

Cases: a null text has no words; a null doc_id comes before all others; rows
that share a doc_id with other texts (or have none) are documents of their own,
by the text's hash, and rows equal in doc_id and text count as one document
(each loses the same words); lists are kept by id and text, so rows without an
id share none that grows with their number; texts of fewer than ``WINDOW`` words
are kept whole; an empty table gives an empty result; other columns are ignored.  Words are compared by 64-bit hashes, contents by their 64-bit hash
and anchor.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.tables import written
from tessera.llm.textops import RangeHash, Slice, _WORD_MULT, cover, keyed_slices, slices, text_slices

WINDOW = 20
GRAM = 8
SHARD_CONTENTS = 4096
HOT_CONTENTS = 2048
NULL_ID = -(1 << 63)

_PLACE_BITS = np.uint64(28)  # words of one slice; the rest of the 64 bits orders grams


def _sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each ``k`` consecutive values."""
    width = 1
    while 2 * width <= k:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = k - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def segments(s: Slice, window: int = WINDOW, gram: int = GRAM):
    """(document, first word in the slice, windows, anchor hash, content hash) arrays of one slice."""
    s.split_words()
    words = s.word_hashes()
    grams_in = window - gram + 1
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), words
    h = RangeHash(words, _WORD_MULT)
    at = np.arange(len(words) - gram + 1)
    grams = h(at, at + gram)
    order = ((grams >> _PLACE_BITS) << _PLACE_BITS) | at.astype(np.uint64)
    best = (_sliding_min(order, grams_in) & np.uint64((1 << 28) - 1)).astype(np.int64)
    w = np.arange(len(best))
    w = w[s.word_doc[w] == s.word_doc[w + window - 1]]
    if not len(w):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), words
    best = best[w]
    new = np.ones(len(w), bool)
    new[1:] = (best[1:] != best[:-1]) | (w[1:] != w[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(w)))
    start = w[first]
    return s.word_doc[start], start, n, grams[best[first]], h(start, start + n + window - 1), words


def _emit_anchors(batches):
    for s in text_slices(batches):
        anchors = segments(s)[3]
        yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64))], names=["anchor"])


def _emit_segments(batches):
    for keys, s in (pair for batch in batches for pair in keyed_slices(batch)):
        doc, start, n, anchor, content, _ = segments(s)
        ids, keys = s.ids.to_numpy(), keys.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(keys[doc]), pa.array((start - s.first[doc]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))], names=["doc_id", "text_key", "start", "n", "anchor", "content"])


def _emit_words(batches):
    """Rows (doc_id, text, list of wanted segments, text_key) -> the segments' word hashes."""
    for batch in batches:
        wanted, keys = batch.column(2), batch.column(3).to_numpy()
        at = 0
        for s in slices(batch.column(0), batch.column(1)):
            s.split_words()
            words = s.word_hashes()
            h = RangeHash(words, _WORD_MULT)
            mine, key = wanted.slice(at, s.n_docs), keys[at:at + s.n_docs]
            at += s.n_docs
            flat = mine.flatten()
            if not len(flat):
                continue
            doc = np.repeat(np.arange(s.n_docs), mine.value_lengths().fill_null(0).to_numpy())
            start, n, anchor, content = (flat.field(k).to_numpy() for k in ("start", "n", "anchor", "content"))
            lo = s.first[doc] + start
            hi = lo + n + WINDOW - 1
            ok = hi <= s.first[doc + 1]  # texts are found by hash
            ok[ok] = h(lo[ok], hi[ok]).view(np.int64) == content[ok]
            lo, hi = lo[ok], hi[ok]
            size = hi - lo
            ends = np.cumsum(size)
            flat_words = words[np.repeat(lo - (ends - size), size) + np.arange(int(size.sum()))]
            binary = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.append(0, ends * 8).astype(np.int32).tobytes()), pa.py_buffer(flat_words.tobytes())])
            ids = s.ids.cast(pa.int64()).to_numpy()[doc[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key[doc[ok]]), pa.array(start[ok]), pa.array(n[ok]), pa.array(anchor[ok]), pa.array(content[ok]), binary, flat.field("hot").filter(pa.array(ok))], names=["doc_id", "text_key", "start", "n", "anchor", "content", "words", "hot"])


class Automaton:
    """Suffix automaton of several word sequences, with the first end place of each state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len, self.end = [-1], [0], [-1]

    def _state(self, length: int, link: int, end: int, to: dict) -> int:
        self.next.append(to)
        self.link.append(link)
        self.len.append(length)
        self.end.append(end)
        return len(self.len) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q], self.end[q], self.next[q].copy())
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, words: list[int], place: int) -> None:
        """Add one sequence whose first word has the given place."""
        last, link, length = 0, self.link, self.len
        for i, word in enumerate(words):
            q = self.next[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, q, word)
                continue
            new = self._state(length[last] + 1, 0, place + i, {})
            p = last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = new
                p = link[p]
            if p != -1:
                q = self.next[p][word]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, q, word)
            last = new

    def matches(self, words: list[int], window: int) -> list[int]:
        """For each window of ``words``, the place of its first occurrence's last word, or -1."""
        out, state, have, link, length = [], 0, 0, self.link, self.len
        for i, word in enumerate(words):
            to = self.next[state].get(word)
            while to is None and state:
                state = link[state]
                have = length[state]
                to = self.next[state].get(word)
            if to is None:
                have = 0
            else:
                state, have = to, have + 1
            if i >= window - 1:
                if have >= window:
                    while length[link[state]] >= window:  # the state of exactly the last `window` words
                        state = link[state]
                    have = min(have, length[state])
                    out.append(self.end[state])
                else:
                    out.append(-1)
        return out


def _first_places(shard: pd.DataFrame) -> pd.DataFrame:
    """Stream the contents of a shard, by first place, through the automaton of those before: the windows found, as bits."""
    shard = shard.sort_values(["doc_id", "text_key", "start"], kind="stable")
    automaton, place, masks = Automaton(), 0, []
    for raw in shard["words"]:
        words = np.frombuffer(raw, np.uint64).tolist()
        found = automaton.matches(words, WINDOW)
        if -1 in found:
            automaton.add(words, place)
            place += len(words)
        masks.append(sum(1 << j for j, end in enumerate(found) if end >= 0))
    return shard[["anchor", "content", "doc_id", "text_key", "start"]].assign(mask=masks)


def _emit_windows(batches):
    """Windows of hot contents: their own hash, with the content and the number in it."""
    for batch in batches:
        doc, key, start, n, anchor, content = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
        raw = batch.column(6)
        if not len(n):
            continue
        words = np.frombuffer(b"".join(raw.to_pylist()), np.uint64)
        size = n + WINDOW - 1
        base = np.cumsum(size) - size
        row = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = base[row] + j
        h = RangeHash(words, _WORD_MULT)(at, at + WINDOW)
        yield pa.RecordBatch.from_arrays([pa.array(anchor[row]), pa.array(content[row]), pa.array(j.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(doc[row]), pa.array(key[row]), pa.array((start[row] + j).astype(np.int32))], names=["anchor", "content", "j", "window", "doc_id", "text_key", "start"])


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, content, mask, n): segments with windows (bits of the mask) that also start earlier.

    ``texts``: doc_id (never null), text and text_key (a hash of the text).
    """
    # written, so that the join below is a plain one, of which Spark splits the hot keys
    anchors = written(texts.mapInArrow(_emit_anchors, "anchor long").groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    held = written(texts.mapInArrow(_emit_segments, "doc_id long, text_key long, start int, n int, anchor long, content long").join(anchors, "anchor"), "segments")
    contents = written(held.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "text_key", "start", "n")).alias("f")).select("anchor", "content", "f.*"), "contents")
    many = contents.groupBy("anchor").count().where(F.col("count") > HOT_CONTENTS).select("anchor", F.lit(True).alias("hot"))
    tagged = contents.join(many, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = tagged.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n", "anchor", "content", "hot")).alias("wanted"))
    one = F.row_number().over(W.partitionBy("doc_id", "text_key").orderBy(F.lit(0)))  # of a row that is repeated
    asked = texts.join(wanted, ["doc_id", "text_key"]).withColumn("copy", one).where("copy = 1")
    worded = written(asked.select("doc_id", "text", "wanted", "text_key")
                     .mapInArrow(_emit_words, "doc_id long, text_key long, start int, n int, anchor long, content long, words binary, hot boolean"), "contents_words")
    shards = max(1, -(-contents.count() // SHARD_CONTENTS))
    by_automaton = (worded.where("NOT hot").drop("hot").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
                    .groupBy("shard").applyInPandas(_first_places, "anchor long, content long, doc_id long, text_key long, start int, mask int"))
    windows = worded.where("hot").drop("hot").mapInArrow(_emit_windows, "anchor long, content long, j int, window long, doc_id long, text_key long, start int")
    first = windows.groupBy("window").agg(F.min(_place()).alias("first"))
    bit = F.element_at(F.array(*(F.lit(1 << b) for b in range(WINDOW))), F.col("j") + 1)
    by_window = (windows.join(first, "window").groupBy("anchor", "content")
                 .agg(F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"), F.min("start").alias("start"), F.bit_or(F.when(F.col("first") < _place(), bit).otherwise(0)).alias("mask")))
    places = by_automaton.unionByName(by_window).select("anchor", "content", _place().alias("first"), "mask")
    every = F.element_at(F.array(*(F.lit((1 << b) - 1) for b in range(1, WINDOW + 1))), F.col("n"))
    found = held.join(places, ["anchor", "content"]).withColumn("mask", F.when(F.col("first") == _place(), F.col("mask")).otherwise(every))
    return found.where("mask > 0").select("doc_id", "text_key", "start", "content", "mask", "n")


def _place():
    return F.struct("doc_id", "text_key", "start")


def _apply(keep_text: bool):
    def apply(batches):
        for batch in batches:
            at = 0
            for s in slices(batch.column(0), batch.column(1)):
                s.split_words()
                words = s.word_hashes()
                mine = batch.column(2).slice(at, s.n_docs)
                at += s.n_docs
                flat = mine.flatten()
                gone = np.zeros(len(words), bool)
                if len(flat):
                    doc = np.repeat(np.arange(s.n_docs), mine.value_lengths().fill_null(0).to_numpy())
                    start, content, mask, n = (flat.field(k).to_numpy() for k in ("start", "content", "mask", "n"))
                    lo = s.first[doc] + start
                    hi = lo + n + WINDOW - 1
                    ok = hi <= s.first[doc + 1]
                    ok[ok] = RangeHash(words, _WORD_MULT)(lo[ok], hi[ok]).view(np.int64) == content[ok]
                    lo, mask = lo[ok], mask[ok]
                    at_windows = [lo[(mask >> j) & 1 == 1] + j for j in range(WINDOW)]
                    gone = cover(len(words), np.concatenate(at_windows), WINDOW)
                removed = np.bincount(s.word_doc[gone], minlength=s.n_docs)
                texts, digests = [], []
                raw = s.data.tobytes()
                for d in range(s.n_docs):
                    a, b = s.first[d], s.first[d + 1]
                    if keep_text and not removed[d]:
                        texts.append(None)  # unchanged
                        continue
                    keep = np.flatnonzero(~gone[a:b]) + a
                    kept = b" ".join([raw[x:y] for x, y in zip(s.starts[keep].tolist(), s.ends[keep].tolist(), strict=True)])
                    if keep_text:
                        texts.append(kept.decode())
                    else:
                        digests.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays([s.ids, pa.array(s.n_words.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(texts if keep_text else digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept" if keep_text else "kept_sha256"])
    return apply


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: n_words, n_removed and the digest of the kept words (or the kept text, null if unchanged)."""
    text = docs[text_col].cast("string")
    texts = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    spans = repeated_spans(texts).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "content", "mask", "n")).alias("spans"))
    last = "kept string" if keep_text else "kept_sha256 string"
    out = texts.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(_apply(keep_text), f"doc_id long, n_words long, n_removed long, {last}")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))
