"""Conversation repair against an exhaustive search, on damaged and on awkward conversations."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from fixtures import words  # noqa: F401  (puts the folder on the path)

from tessera.llm import conversation_repair as cr
from tessera.llm.queries import damaged_rows

WHITE = " \t\n\x0b\x0c\r"
NULLS = lambda t: (t is not None, t or 0)


def damaged(rows):
    """The contract's damage, row by row: {conv: [(turn, role, text)]}; every conversation has a key."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired lines) by search over all edits, cheapest and then least first."""
    import heapq
    nxt = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, lines
        if (i, state, audit) in done:
            continue
        done.add((i, state, audit))
        for initial, role in (("u", "user"), ("a", "assistant")):
            if (initial, state) in nxt and audit[-3:] != "III":
                heapq.heappush(heap, (cost + 3, audit + "I", i, nxt[initial, state], (*lines, role + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if found[i] in ("", "truncated"):
                more = 3 if found[i] else 0
                if role and (role[0], state) in nxt:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, nxt[role[0], state], (*lines, f"{role}:{text}")))
                for initial, to in (("u", "user"), ("a", "assistant")):
                    if (initial, state) in nxt:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, nxt[initial, state], (*lines, f"{to}:{text}")))


def expected(rows):
    out = {}
    for conv, mine in damaged(rows).items():
        mine.sort(key=lambda r: NULLS(r[0]))
        found = faults(mine)
        cost, audit, lines = cheapest(mine, found)
        turns = {t for t, _, _ in mine if t is not None}
        initials = [r[:1] for _, r, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_rows(seed, conversations, turns):
    r = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(r.randint(0, turns)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sage"])
            text = r.choice(["Yes.", "No!", "why", "  ", "", None, "ok.\n", f"text {r.randint(0, 99)}.", "é"])
            rows.append((None if c == 3 else c, None if r.random() < 0.05 and t == 0 else t * r.choice([1, 1, 1]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, conv string, n int, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, None) for r in rows], SCHEMA)


def results(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("segment, group", [(cr.SEGMENT, cr.GROUP_SYMBOLS), (2, 5)])
def test_equals_exhaustive_search(spark, segment, group):
    rows = random_rows(5, 150, 6)
    got = cr.repair(damaged_rows(frame(spark, rows)), segment, group)
    assert results(got) == expected(rows)


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert results(cr.repair(damaged_rows(table))) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_empty_table(spark):
    assert cr.repair(damaged_rows(frame(spark, []))).count() == 0


def test_one_conversation_in_many_segments(spark):
    """A conversation with most rows, many of them equal, is solved from pieces of many tasks as it is from one string."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"say {t % 50}." if t % 3 else f"say {t}.") for t in range(3000)] + [(c, 0, "user", "Hi.") for c in range(2, 400)]
    frame_ = frame(spark, rows)
    assert results(cr.repair(damaged_rows(frame_), 64)) == results(cr.repair(damaged_rows(frame_)))


def test_repeated_rows(spark):
    """Equal rows of one turn stand side by side; all but the first are duplicates."""
    rows = [(1, 1, "user", "Go.")] * 40 + [(1, 2, "assistant", "Gone.")]
    got = results(cr.repair(cr.rows_of(frame(spark, rows))))
    assert got[1][:7] == (0, 0, 39, 0, 39, 4 * 39, "K" + "D" * 39 + "K")


def test_grammar_spells_the_strings_back():
    r = np.random.default_rng(2)
    strings = [r.integers(0, 3, r.integers(0, 60)) for _ in range(50)] + [np.zeros(200, np.int64)]
    short, rules = cr.re_pair(strings, 3)

    def spell(symbol):
        return [symbol] if symbol < 3 else spell(rules[symbol - 3][0]) + spell(rules[symbol - 3][1])
    assert [[x for symbol in s for x in spell(symbol)] for s in short] == [s.tolist() for s in strings]
    pairs = defaultdict(int)
    for s in short:
        last = None
        for pair in zip(s[:-1].tolist(), s[1:].tolist(), strict=True):
            if pair[0] == pair[1] and last == pair:
                last = None
                continue
            last = pair
            pairs[pair] += 1
    assert max(pairs.values(), default=1) == 1
    assert sum(map(len, short)) < sum(map(len, strings)) / 3


def test_products_equal_the_plain_chain():
    """Matrices by grammar equal the product row by row, audits spelled out."""
    r = random.Random(9)
    strings = ["".join(r.choice(cr.SYMBOLS) for _ in range(r.randint(0, 12))) for _ in range(40)]
    for s, m in zip(strings, cr.matrices(strings), strict=True):
        plain = cr.UNIT
        for symbol in s:
            plain = cr.product(plain, cr.terminal(symbol))
        for e in range(16):
            assert (m[e] is None) == (plain[e] is None)
            if m[e] is not None:
                assert (m[e][0], cr.spelled(m, e)) == (plain[e][0], cr.spelled(plain, e))
