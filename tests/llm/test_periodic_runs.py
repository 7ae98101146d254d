"""Periodic runs against a plain search over all periods."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from fixtures import DOC_SCHEMA, edge_docs, prose, words

from tessera.llm import periodic_runs as pr
from tessera.llm.queries import op12_periodic_runs, repeated_tails


def all_runs(w, least=12):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                found.setdefault((i, j - i + p), p)  # the least period of a stretch comes first
            i = j
    return sorted(((a, n, p) for (a, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def with_tail(doc, text):
    w = words(text)
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


@pytest.mark.parametrize("least", [2, 5, 12])
def test_random_sequences(least):
    r = random.Random(least)
    for _ in range(300):
        n = r.randint(0, 70)
        w = [r.randint(0, r.choice([0, 1, 2, 6])) for _ in range(n)]
        if n and r.random() < 0.6:
            a, p = r.randrange(n), r.randint(1, 9)
            w = [w[i] if i < a + p else None for i in range(n)]
            for i in range(a + p, n):
                w[i] = w[i - p]
        x = np.array(w, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(5)
        got = list(zip(*(c.tolist() for c in pr.runs(x, least)), strict=True))
        assert got == all_runs(w, least), w


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 300):
        w = r.integers(0, 3, n).astype(np.uint64)
        order, rank = pr.suffix_array(w)
        assert order.tolist() == sorted(range(n), key=lambda i: w[i:].tolist())
        assert all(rank[order[i]] == i for i in range(n))


def test_long_regular_sequences():
    one = np.full(50_000, 7, np.uint64)
    assert [c.tolist() for c in pr.runs(one)] == [[0], [50_000], [1]]
    morse = np.array([bin(i).count("1") % 2 + 1 for i in range(3000)], np.uint64)
    assert list(zip(*(c.tolist() for c in pr.runs(morse)), strict=True)) == all_runs(morse.tolist())


def test_documents(spark):
    rows = [(i, " ".join(random.Random(i).choice("abc") for _ in range(i % 90))) for i in range(150)]
    rows += [(1, "a b " * 30), (1, "a b " * 30), (None, "x\n" * 20), (2, None), (3, " \t"), (4, prose(1, 30_000)), (5, "\x1c é " * 9)]
    docs = spark.createDataFrame([(i, t, None, None, 1, "w", 2, "r", 3, 4, "s") for i, t in rows], DOC_SCHEMA)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.find_runs(docs).collect())
    want = []
    for i, t in rows:
        w = words(t)
        found = all_runs(w) if len(w) < 1000 else []
        want.append((i is not None, i or 0, len(w), found, collapsed(w, found)))
    assert got == sorted(want)
    assert pr.find_runs(docs.limit(0)).count() == 0


def test_query_with_repeated_tails(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == text.keys()
    planted = 0
    for i, t in text.items():
        w = with_tail(i, t)
        if len(w) > 1500:
            continue
        runs = all_runs(w)
        best = min(((-n, a, p) for a, n, p in runs), default=None)
        want = (len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4), hashlib.sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest())
        assert tuple(got[i])[1:] == want
        planted += bool(runs)
    assert planted > 10
    edge = {r["doc_id"]: r["text"] for r in repeated_tails(edge_docs(spark)).collect()}
    assert edge[1] is None and words(edge[8]) == with_tail(8, "é　ü​ @ 日本")
