"""Best-fit packing: bin-completion branch and bound over token sequences.

Documents become token pieces; pieces are dealt evenly to groups of about
``GROUP_PIECES`` (a pure function of where the piece was read, so no key can be
hot), and every group is packed by itself, wasting at most part of one
sequence against packing all groups together.

In a group the largest open piece is completed: the undominated fillings of the
room beside it are enumerated one by one, fullest first (bit sets of reachable
sums steer the enumeration); an exact single piece has no alternative, a filling
whose pieces fit into those of one tried before is left out, and a branch is cut
when its waste exceeds what the incumbent minus one sequence allows.  The first
incumbents are best fit decreasing and a few dives: first fillings only, each dive
completed by best fit from several places on.  A search that meets the lower bound stops, one
that runs out of branches has proved its incumbent, and one that has looked at
``MAX_NODES`` fillings since the last improvement keeps the incumbent (which is a
whole packing).

Cases: a null or empty text is the end id alone; repeated rows are packed one
by one; an empty table gives an empty result; a text longer than a sequence is
cut into full pieces behind a shorter first one; other columns are ignored.
"""
from __future__ import annotations

import base64
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import written
from tessera.llm.textops import worker_cache

SEQUENCE = 1024
END_ID = 2
GROUP_PIECES = 1 << 14
MAX_NODES = 20_000  # fillings looked at since the last improvement
SLACKS = (4, 0, 2)  # of the dives; the search goes on with that of the best
COMPLETIONS = 12  # places of a dive from which best fit completes it
MOST_COMPARED = 6  # pieces of a filling that is compared with those tried before
MEMO_WORDS = 400_000  # words whose ids a Python worker keeps; others are encoded anew
MEMO_CHARS = 40  # of a word that is kept

_ODD_SPACE = re.compile(r"[^\S \n]|  | \n|\n ")  # spacing at which words can't be encoded one by one
_SPECIAL = "<|endoftext|>"


def default_vocabulary() -> tuple[str, str]:
    """(ranks file, split pattern) of the public byte-level vocabulary ``byte_bpe_50k``."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    In a text whose only spacing is single blanks and line ends, the vocabulary's
    split pattern never crosses a blank except to put it in front of the next
    word, so ids of the pieces between blanks are remembered and joined.  Other
    texts, and those with the special token's string, are encoded whole.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={_SPECIAL: 50256})
        plain = self._enc.encode_ordinary

        class Memo(dict):
            def __missing__(self, word):
                ids = array("I", plain(" " + word)).tobytes()
                if len(self) < MEMO_WORDS and len(word) <= MEMO_CHARS:
                    self[word] = ids
                return ids

        self._memo = Memo()

    def __call__(self, text: str) -> bytes:
        if _SPECIAL in text:
            return array("I", self._enc.encode(text, allowed_special="all")).tobytes()
        if _ODD_SPACE.search(text):
            return array("I", self._enc.encode_ordinary(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self._enc.encode_ordinary(first)).tobytes() + b"".join(map(self._memo.__getitem__, rest))


def _encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary, kept between tasks."""
    kept = worker_cache("encoders")
    if (ranks_path, pattern) not in kept:
        kept[ranks_path, pattern] = Encoder(ranks_path, pattern)
    return kept[ranks_path, pattern]


def cut(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``n`` ids: full ones behind a shorter first one."""
    head = n % size
    starts = ([0] if head else []) + list(range(head, n, size))
    return list(zip(starts, [*starts[1:], n], strict=True))


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])


def _piecer(ranks_path: str, pattern: str):
    def pieces(batches):
        encode, nth = _encoder(ranks_path, pattern), 0
        task = TaskContext.get().partitionId()
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            cols = [[] for _ in _PIECES]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for k, (a, b) in enumerate(cut(len(ids) // 4)):
                    for c, v in zip(cols, (doc, k, a, b - a, zlib.crc32(ids[4 * a:4 * b]), task, nth), strict=True):
                        c.append(v)
                    nth += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECES, strict=True)], schema=_PIECES)
    return pieces


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Pieces of all documents, written once (they are counted before they are packed)."""
    texts = docs.select(docs[id_col].cast("long"), docs[text_col].cast("string"))
    return written(texts.mapInArrow(_piecer(*(vocabulary or default_vocabulary())), "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"), "pieces")


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Best fit decreasing: each size goes where the least room is left."""
    bins: list[list[int]] = []
    left: list[tuple[int, int]] = []  # (room left, bin), sorted
    for s in sorted(sizes, reverse=True):
        i = bisect_left(left, (s, -1))
        if i == len(left):
            bins.append([s])
            insort(left, (room - s, len(bins) - 1))
        else:
            r, b = left.pop(i)
            bins[b].append(s)
            insort(left, (r - s, b))
    return bins


class _Sizes:
    """A multiset of sizes with the largest one not above a bound."""

    def __init__(self, sizes: list[int]):
        self.n: dict[int, int] = {}
        for s in sizes:
            self.n[s] = self.n.get(s, 0) + 1
        self.order = sorted(self.n)

    def take(self, s: int) -> None:
        self.n[s] -= 1
        if not self.n[s]:
            del self.order[bisect_left(self.order, s)]

    def put(self, s: int) -> None:
        self.n[s] += 1
        if self.n[s] == 1:
            insort(self.order, s)

    def below(self, bound: int) -> int:
        i = bisect_right(self.order, bound)
        return self.order[i - 1] if i else 0


def _reachable(open_: _Sizes, room: int) -> list[int]:
    """Bit sets of the sums up to ``room`` of the smallest sizes: item i for the first i different ones."""
    out, mask = [1], (1 << (room + 1)) - 1
    for x in open_.order[:bisect_right(open_.order, room)]:
        bits, n, step = out[-1], min(open_.n[x], room // x), 1
        while n > 0:  # counts in powers of two
            step = min(step, n)
            bits |= bits << (x * step)
            n -= step
            step *= 2
        out.append(bits & mask)
    return out


def _sets(open_: _Sizes, reach: list[int], total: int, to: int, used: dict[int, int]) -> Iterator[tuple[int, ...]]:
    """Sets of open sizes, largest first, that add up to ``total`` and use the first ``to`` different sizes."""
    for j in range(min(to, bisect_right(open_.order, total)) - 1, -1, -1):
        if not reach[j + 1] >> total & 1:
            return
        x = open_.order[j]
        if used.get(x, 0) < open_.n[x]:
            if x == total:
                yield (x,)
            elif reach[j + 1] >> (total - x) & 1:
                used[x] = used.get(x, 0) + 1
                for rest in _sets(open_, reach, total - x, j + 1, used):
                    yield (x, *rest)
                used[x] -= 1


def fillings(open_: _Sizes, room: int) -> Iterator[tuple[int, ...]]:
    """Sets of open sizes for ``room`` by falling sum, one by one; the open sizes must not change meanwhile.

    A single size takes the place of every set that is no larger, so the sets
    end with the largest single size that fits, and one that fits exactly is the
    only filling.
    """
    top = open_.below(room)
    if top in (0, room):
        yield (top,) if top else ()
        return
    for i in range(bisect_right(open_.order, room) - 1, -1, -1):  # exact pairs need no sums
        a = open_.order[i]
        if 2 * a < room:
            break
        if open_.n.get(room - a, 0) > (2 * a == room):
            yield (a, room - a)
    reach = _reachable(open_, room)
    for total in range(room, top, -1):
        if reach[-1] >> total & 1:
            for s in _sets(open_, reach, total, len(reach) - 1, {}):
                if len(s) > 2 or total < room:
                    yield s
    yield (top,)


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the sizes of ``b`` can be dealt to those of ``a`` so that none overflows (then ``b`` needn't be tried besides ``a``)."""
    left = list(a)

    def place(i: int) -> bool:
        if i == len(b):
            return True
        for k in range(len(left)):
            if left[k] >= b[i] and left[k] not in left[:k]:
                left[k] -= b[i]
                if place(i + 1):
                    return True
                left[k] += b[i]
        return False
    return place(0)


def lower_bound(sizes: list[int], room: int = SEQUENCE) -> int:
    """Bins that any packing needs: for each k, sizes above ``room - k`` stand alone and those from k to half must fit beside the larger half."""
    n = np.bincount(np.asarray(sizes, np.int64), minlength=room + 1)
    count, total = np.append(np.cumsum(n[::-1])[::-1], 0), np.append(np.cumsum((n * np.arange(room + 1))[::-1])[::-1], 0)
    k = np.arange(room // 2 + 1)
    large, alone = count[room // 2 + 1], count[room - k + 1]
    free = (large - alone) * room - (total[room // 2 + 1] - total[room - k + 1])
    rest = total[k] - total[room // 2 + 1]
    return int((large + np.maximum(0, -(-(rest - free) // room))).max())


def ordered_fillings(open_: _Sizes, room: int, slack: int) -> Iterator[tuple[int, ...]]:
    """The fillings by falling sum, but first the largest single size if it leaves no more than ``slack``: it takes a
    large piece out of the way that may be hard to place later, for little waste."""
    top = open_.below(room)
    early = top and room - top <= slack
    if early:
        yield (top,)
    for f in fillings(open_, room):
        if not (early and f == (top,)):
            yield f


def dive(sizes: list[int], room: int, slack: int, completions: int = COMPLETIONS) -> list[list[int]]:
    """The best of: every node's first filling to the end, or up to one of ``completions`` places and best fit from there on."""
    open_, bins, best = _Sizes(sizes), [], None
    every = max(1, len(sizes) // (2 * completions))
    while open_.order:
        if bins and len(bins) % every == 0:
            rest = best_fit([s for s in open_.order for _ in range(open_.n[s])], room)
            if best is None or len(bins) + len(rest) < len(best):
                best = [*bins, *rest]
        big = open_.order[-1]
        open_.take(big)
        f = next(ordered_fillings(open_, room - big, slack))
        for s in f:
            open_.take(s)
        bins.append([big, *f])
    return bins if best is None or len(bins) <= len(best) else best


def bin_completion(sizes: list[int], room: int = SEQUENCE, max_nodes: int = MAX_NODES) -> list[list[int]]:
    """A packing of ``sizes`` into as few bins of ``room`` as the search finds; the fewest if it ends before its budget."""
    best, slack = best_fit(sizes, room), SLACKS[0]
    least, total = lower_bound(sizes, room), sum(sizes)
    for k in SLACKS:
        if len(best) > least and len(found := dive(sizes, room, k)) < len(best):
            best, slack = found, k
    open_, bins, waste, nodes = _Sizes(sizes), [], 0, 0
    tried: list[list[tuple[int, ...]]] = [[]]
    while len(best) > least and nodes < max_nodes:
        spare = (len(best) - 1) * room - total - waste  # waste that a better packing can still have
        filling = None
        if open_.order and spare >= 0:
            big = open_.order[-1]
            open_.take(big)
            for f in ordered_fillings(open_, room - big, slack):
                nodes += 1
                if room - big - sum(f) > spare:
                    if len(f) != 1:  # those behind are no fuller; a single size may stand before fuller ones
                        break
                    continue
                if f not in tried[-1] and (len(f) > MOST_COMPARED or not any(dominates(t, f) for t in tried[-1])):
                    filling = f
                    break
            open_.put(big)
        elif spare >= 0:
            best, nodes = [list(b) for b in bins], 0
        if filling is None:  # back to the bin before
            tried.pop()
            if not bins:
                break
            last = bins.pop()
            waste -= room - sum(last)
            for s in last:
                open_.put(s)
            continue
        tried[-1].append(filling)
        tried.append([])
        bins.append((big, *filling))
        waste += room - big - sum(filling)
        for s in bins[-1]:
            open_.take(s)
    return best


def _pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["length", "task", "nth"], kind="stable").reset_index(drop=True)
    lengths = group["length"].to_numpy()
    waiting: dict[int, list[int]] = {}
    for i, n in enumerate(lengths.tolist()):
        waiting.setdefault(n, []).append(i)
    full = waiting.pop(SEQUENCE, [])
    bins = [[SEQUENCE]] * len(full) + bin_completion([n for n, rows in waiting.items() for _ in rows])
    waiting[SEQUENCE] = full
    sequence, offset = [0] * len(group), [0] * len(group)
    for b, members in enumerate(bins):
        at = 0
        for n in members:
            i = waiting[n].pop()
            sequence[i], offset[i] = (int(key[0]) << 32) + b, at
            at += n
    return group.assign(sequence_id=sequence, offset=offset)[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]


def pack(pieces: DataFrame, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("task", "nth"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(_pack, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
