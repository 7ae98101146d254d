"""Byte-level BPE: encoding by rounds over padded matrices, decoding by gathering token bytes.

A text is split by the vocabulary's pattern.  The different pieces of a slice of
documents are encoded once: a piece that is a token takes that token's id; the
others start as byte tokens, in matrices of rows of similar length (padded on
the right).  In each round every row merges its leftmost pair of the least
rank: the rank matrix gives the place, a hashed pair table the ranks of the two
pairs that the merge changes, and the place behind the merge is squeezed out, so
all rows of a matrix lose one column a round.  Rows without a pair leave.

A piece beyond ``LONG_PIECE`` bytes is a row of its own whose equal pairs merge in
one round, up to the first one whose new neighbours rank lower (there the order
of single merges would turn to that neighbour), so its rounds follow the number
of different pairs, not its length.

Ranks are the ids: a pair's rank is the id of the token with its bytes.  Ids are
those of the usual encoder of rank files for each match of the pattern, without
special tokens; decoding gives the text's UTF-8 bytes back.

Cases: a null text counts as empty and has no ids; every row gives a row (repeated
rows too); an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.textops import slices, worker_cache

LONG_PIECE = 256
MATRIX_CELLS = 1 << 21
SLICE_BYTES = 2 << 20
PAD = 0xFFFFFFFF
NO_PAIR = np.int32((1 << 31) - 1)

_EMPTY = np.uint64((1 << 64) - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> tuple[str, str]:
    """(ranks file, split pattern) of the public byte-level vocabulary for many languages."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


class PairTable:
    """Hash table (left id, right id) -> id of the merged token, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(4 * len(merged)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self._keys = np.full(1 << bits, _EMPTY)
        self._values = np.full(1 << bits, NO_PAIR)
        keys = self._key(left, right)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            _, first = np.unique(slot, return_index=True)
            first = first[self._keys[slot[first]] == _EMPTY]
            self._keys[slot[first]] = keys[rest[first]]
            self._values[slot[first]] = merged[rest[first]]
            waits = np.ones(len(rest), bool)
            waits[first] = False
            rest, slot = rest[waits], (slot[waits] + np.uint64(1)) & self._mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MULT) >> self._shift) & self._mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NO_PAIR`` where it is no token."""
        keys = self._key(left, right)
        slot = self._slot(keys)
        found = self._keys[slot]
        out = np.where(found == keys, self._values[slot], NO_PAIR)
        open_ = np.flatnonzero((found != keys) & (found != _EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + np.uint64(1)) & self._mask
            found = self._keys[slot]
            hit = found == keys[open_]
            out[open_[hit]] = self._values[slot[hit]]
            on = ~hit & (found != _EMPTY)
            open_, slot = open_[on], slot[on]
        return out


def gather(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The records ``which`` of a ragged array: (values, offsets)."""
    size = (offsets[1:] - offsets[:-1])[which]
    out = np.zeros(len(which) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    at = np.arange(out[-1]) + np.repeat(offsets[which] - out[:-1], size)
    return values[at], out


def _ragged(records: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(records) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, records), np.int64, len(records)), out=offsets[1:])
    return np.frombuffer(b"".join(records), np.uint8), offsets


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._split = regex.compile(pattern).findall
        self._byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.uint32)
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, merged = (np.array(c) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 3
        self._pairs = PairTable(left, right, merged.astype(np.int32))
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self._bytes, self._byte_offsets = _ragged(by_id)

    def merge_rows(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge padded rows of byte tokens until none has a pair: [(numbers of rows, their padded ids)]."""
        done, number = [], np.arange(len(rows))
        ranks = self._pairs.ranks(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(rows):
            if not ranks.shape[1]:
                done.append((number, rows))
                break
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            on = least != NO_PAIR
            if not on.all():
                done.append((number[~on], rows[~on]))
                rows, ranks, number, at, least = rows[on], ranks[on], number[on], at[on], least[on]
            n, width = rows.shape
            each = np.arange(n)
            rows[each, at] = least
            keep = np.ones((n, width), bool)
            keep[each, at + 1] = False
            rows = rows[keep].reshape(n, width - 1)
            keep = keep[:, 1:]
            ranks = ranks[keep].reshape(n, width - 2)
            for first, valid in ((at - 1, at > 0), (at, at < width - 2)):  # the pairs before and behind the merged one
                r, c = each[valid], first[valid]
                ranks[r, c] = self._pairs.ranks(rows[r, c], rows[r, c + 1])
        return done

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: all pairs of the least rank that single merges would take one after the other, in one round."""
        ranks = self._pairs.ranks(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != NO_PAIR:
            at = np.flatnonzero(ranks == least)
            fresh = np.append(True, np.diff(at) > 1)  # a pair of equal ids overlaps the next: every second one of a run merges
            start = at[fresh][np.cumsum(fresh) - 1]
            at = at[(at - start) % 2 == 0]
            left = np.where(np.append(False, np.diff(at) == 2), least, ids[at - 1]).astype(np.uint32)
            before = np.where(at > 0, self._pairs.ranks(left, np.full(len(at), least)), NO_PAIR)
            right = ids[np.minimum(at + 2, len(ids) - 1)]
            after = np.where(at + 2 < len(ids), self._pairs.ranks(np.full(len(at), least), right), NO_PAIR)
            lower = np.flatnonzero(np.minimum(before, after) < least)
            if len(lower):
                at = at[:lower[0] + 1]
            ids[at] = least
            ids, ranks = np.delete(ids, at + 1), np.delete(ranks, at)
            new = at - np.arange(len(at))
            again = np.concatenate([new - 1, new])
            again = again[(again >= 0) & (again < len(ranks))]
            ranks[again] = self._pairs.ranks(ids[again], ids[again + 1])
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece: (ids, offsets)."""
        whole = [self.ranks.get(p, -1) for p in pieces]
        data, offsets = _ragged(pieces)
        size = np.diff(offsets)
        count = np.where(size > 0, 1, 0)
        rest = np.flatnonzero((np.array(whole, np.int64) < 0) & (size > 0))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        rest = rest[np.argsort(size[rest], kind="stable")]
        at = 0
        while at < len(rest):
            least = int(size[rest[at]])
            if least > LONG_PIECE:
                p = rest[at]
                found.append((np.array([p]), self.merge_long(self._byte[data[offsets[p]:offsets[p + 1]]])[None, :]))
                at += 1
                continue
            to = at + int(np.searchsorted(size[rest[at:at + MATRIX_CELLS // least]], min(LONG_PIECE, least + least // 4), side="right"))
            bucket = rest[at:to]
            width = int(size[bucket[-1]])
            place = np.arange(width)
            inside = place < size[bucket, None]
            rows = np.full((len(bucket), width), PAD, np.uint32)
            rows[inside] = self._byte[gather(data, offsets, bucket)[0]]
            found += [(bucket[number], ids) for number, ids in self.merge_rows(rows)]
            at = to
        for number, ids in found:
            count[number] = (ids != PAD).sum(1)
        out_offsets = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(count, out=out_offsets[1:])
        out = np.zeros(out_offsets[-1], np.int32)
        single = np.flatnonzero(np.array(whole, np.int64) >= 0)
        out[out_offsets[single]] = np.array(whole, np.int64)[single]
        for number, ids in found:
            used = ids != PAD
            row, column = np.nonzero(used)
            out[out_offsets[number][row] + column] = ids[used]
        return out, out_offsets

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text: (ids, offsets)."""
        flat: list[str] = []
        ends = [0]
        for text in texts:
            flat += self._split(text)
            ends.append(len(flat))
        coded = pa.array(flat, pa.large_string()).dictionary_encode()
        pieces = coded.dictionary.cast(pa.large_binary()).to_pylist()
        ids, offsets = gather(*self.encode_pieces(pieces), coded.indices.to_numpy())
        return ids, offsets[np.array(ends)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each sequence of ids: (bytes, offsets)."""
        data, ends = gather(self._bytes, self._byte_offsets, ids)
        return data, ends[offsets]


def _bpe(ranks_path: str, pattern: str) -> ByteBpe:
    """One encoder per Python worker and vocabulary, kept between tasks."""
    kept = worker_cache("byte_bpe")
    if (ranks_path, pattern) not in kept:
        kept[ranks_path, pattern] = ByteBpe(ranks_path, pattern)
    return kept[ranks_path, pattern]


def _id_list(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))


def _encoded(vocabulary: tuple[str, str]):
    def run(batches):
        bpe = _bpe(*vocabulary)
        for batch in batches:
            for s in slices(batch.column(0), batch.column(1), SLICE_BYTES):
                ids, offsets = bpe.encode([s.text(d).decode() for d in range(s.n_docs)])
                yield pa.RecordBatch.from_arrays([s.ids, _id_list(ids, offsets)], names=["doc_id", "ids"])
    return run


def _decoded(vocabulary: tuple[str, str]):
    def run(batches):
        bpe = _bpe(*vocabulary)
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().fill_null(0).to_numpy()
            offsets = np.append(0, np.cumsum(size))
            at = 0
            while at < len(size):  # as many sequences at once as decode to about a slice
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES // 4, side="right")) - 1)
                data, ends = bpe.decode(lists.slice(at, to - at).flatten().to_numpy(), offsets[at:to + 1] - offsets[at])
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), lists.slice(at, to - at), out.cast(pa.binary())], names=["doc_id", "ids", "decoded"])
                at = to
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id and ``ids`` of every row's whole text."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return texts.mapInArrow(_encoded(vocabulary or default_vocabulary()), "doc_id long, ids array<int>")


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, ``ids`` and the bytes that they stand for (``decoded``); null ids count as none."""
    rows = coded.select(coded[id_col].cast("long").alias("doc_id"), coded[ids_col].cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoded(vocabulary or default_vocabulary()), "doc_id long, ids array<int>, decoded binary")
