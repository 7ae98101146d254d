import random
import zlib
from collections import defaultdict

import numpy as np
from fixtures import edge_docs, sample

from tessera.llm import packing


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizer(spark):
    t, encode = tokenizer(), packing.Encoder(*packing.default_vocabulary())
    texts = [r.text for r in sample(spark).collect()]
    texts += ["a  b", "a\n \nb", "a   b ", "x<|endoftext|>y <|endoftext|>", " lead", "trail ", "\n\n a\tb   c", "a　b c", "a   b", "it's we'll 123 4é５", ""]
    r = random.Random(1)
    texts += ["".join(r.choice(" \n\t.a1é' s") for _ in range(40)) for _ in range(500)]
    for x in texts:
        assert np.frombuffer(encode(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(1024) == [(0, 1024)]
    assert packing.cut(1025) == [(0, 1), (1, 1025)]
    assert packing.cut(3000) == [(0, 952), (952, 1976), (1976, 3000)]


def test_bin_completion_packs_all_and_beats_best_fit():
    r = random.Random(3)
    gains = 0
    for n, draw in ((400, lambda: r.randint(1, 1023)), (300, lambda: r.randint(300, 600)), (200, lambda: r.choice([400, 350, 300, 511])), (60, lambda: r.randint(200, 500)), (0, None), (1, lambda: 5)):
        sizes = [draw() for _ in range(n)]
        bins = packing.bin_completion(sizes)
        assert sorted(x for b in bins for x in b) == sorted(sizes)
        assert all(sum(b) <= 1024 for b in bins)
        first = packing.best_fit(sizes, 1024)
        assert -(-sum(sizes) // 1024) <= len(bins) <= len(first)
        gains += len(first) - len(bins)
    assert gains > 0


def test_small_cases_are_optimal():
    import functools
    r = random.Random(8)

    @functools.cache
    def least(sizes, rooms):
        if not sizes:
            return 0
        s, rest = sizes[0], sizes[1:]
        best = 1 + least(rest, tuple(sorted((*rooms, 100 - s))))
        for i, room in enumerate(rooms):
            if room >= s:
                best = min(best, least(rest, tuple(sorted(rooms[:i] + rooms[i + 1:] + (room - s,)))))
        return best

    above = 0
    for _ in range(150):
        low, high = r.choice([(10, 70), (20, 55), (1, 100)])
        sizes = sorted((r.randint(low, high) for _ in range(r.randint(0, 10))), reverse=True)
        best = least(tuple(sizes), ())
        assert packing.lower_bound(sizes, 100) <= best
        assert len(packing.bin_completion(list(sizes), 100)) == best
        above += len(packing.best_fit(sizes, 100)) > best
    assert above > 0


def test_fillings_fall_and_are_complete():
    """Every set that isn't dominated by a single size comes, by falling sum."""
    from itertools import combinations
    r = random.Random(2)
    for _ in range(100):
        sizes = [r.randint(1, 30) for _ in range(r.randint(0, 8))]
        open_ = packing._Sizes(sizes)
        room = r.randint(1, 60)
        got = list(packing.fillings(open_, room))
        assert sum(map(sum, got)) == 0 or [sum(f) for f in got] == sorted((sum(f) for f in got), reverse=True)
        top = max((s for s in sizes if s <= room), default=0)
        want = {tuple(sorted(c, reverse=True)) for n in range(1, len(sizes) + 1) for c in combinations(sizes, n) if top < sum(c) <= room}
        want = {(top,)} if top == room else want | ({(top,)} if top else {()})
        assert set(got) == want and len(got) == len(want)


def test_dominance():
    assert packing.dominates((60, 40), (30, 30, 40)) and packing.dominates((60, 40), (59, 40)) and packing.dominates((5,), ())
    assert not packing.dominates((60, 40), (50, 50)) and not packing.dominates((30, 30), (60,))


def test_large_groups_end_near_the_bound():
    r = random.Random(3)
    sizes = [min(1023, int(r.lognormvariate(6, 0.9)) + 1) for _ in range(6000)]
    packed = packing.bin_completion(sizes)
    assert sorted(s for b in packed for s in b) == sorted(sizes) and max(map(sum, packed)) <= 1024
    assert len(packed) <= packing.lower_bound(sizes) * 1.01 and len(packed) <= len(packing.best_fit(sizes, 1024))


def test_packed_pieces_are_whole(spark):
    docs = sample(spark)
    t = tokenizer()
    placed = packing.pack(packing.token_pieces(docs), group_pieces=64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in placed:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for r in docs.collect():
        ids = t.encode(r.text, add_special_tokens=False).ids + [2]
        mine = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        assert [p.piece for p in mine] == list(range(len(mine)))
        assert sum(p.length for p in mine) == len(ids) and all(p.length == 1024 for p in mine[1:])
        for p in mine:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    for s in by_sequence.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    total = sum(p.length for p in placed)
    assert len(by_sequence) <= -(-total // 1024) * 1.03 + 8
