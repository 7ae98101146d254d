from collections import defaultdict

import numpy as np
import pytest
from fixtures import sample, words

from tessera.llm import ngram_join as nj


def plain(rows, threshold=0.8, n=5):
    grams = {}
    for i, t in rows:
        w = words(t)
        if w:
            grams[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) or frozenset([tuple(w)])
    parent, links = {i: i for i, _ in rows}, defaultdict(int)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in grams:
        for j in grams:
            if i < j and len(grams[i] & grams[j]) >= threshold * len(grams[i] | grams[j]):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (top(i), links[i]) for i, _ in rows}


def rows_of(spark):
    base = [f"w{k}" for k in range(200)]
    near = [" ".join(base[:k] + [f"x{k}"] + base[k + 1:]) for k in range(0, 200, 9)]
    more = [*near, "a b", "a  b", "", None, " ".join(base[:150]), " ".join(base[:130])]
    docs = sample(spark).select("doc_id", "text")
    return docs.union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))


@pytest.mark.parametrize("block, size", [(7, 16 << 20), (1024, 16 << 20), (1024, 4000)])
def test_equals_brute_force(spark, monkeypatch, block, size):
    """In one block, and with clusters cut into several by number or by bytes."""
    monkeypatch.setattr(nj, "BLOCK", block)
    monkeypatch.setattr(nj, "BLOCK_BYTES", size)
    docs = rows_of(spark)
    got = {r.doc_id: (r.class_id, r.n_links) for r in nj.join(docs).collect()}
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want and sum(n for _, n in want.values()) > 100


def test_one_of_each_group(spark):
    docs = rows_of(spark)
    docs = docs.union(docs.where("doc_id = 0 OR doc_id = 10000"))  # repeated rows
    want = plain([(r.doc_id, r.text) for r in docs.distinct().collect()])
    kept = [r.doc_id for r in nj.one_of_each(docs).collect()]
    assert sorted(kept) == sorted(i for i, (c, _) in want.items() if c == i)


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.95)):
        bands, rows = nj.choose_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall
    with pytest.raises(ValueError):
        nj.choose_bands(0.01, 0.999, 10)


def test_intersections_are_exact(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 120)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for common in (0, 4, 48):
        monkeypatch.setattr(nj, "COMMON", max(common, 1))
        assert nj.intersections(sets).astype(int).tolist() == want


def test_components_of_any_graph(spark):
    """Chains, stars whose centre is the largest, loops, repeats and random edges against union-find."""
    from tessera.llm.graph import components
    r = np.random.default_rng(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(i + 1, i) for i in range(400, 430)] + [(299, i) for i in range(200, 240)] + [(7, 7), (300, 301), (301, 300), (300, 301)]
    edges += [tuple(e) for e in r.integers(1000, 1200, (130, 2)).tolist()]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent if x != 7 and any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_candidate_edges_are_few(spark):
    """A group of near copies needs about an edge a class, though its bands name many centres."""
    r = np.random.default_rng(4)
    rows = []
    for c in range(600):
        rows += [(c, int(min(c, x))) for x in r.integers(0, 600, 20)]
    member = spark.createDataFrame(rows, "class long, center long")
    edges = nj._candidate_edges(member).collect()
    assert len(edges) < len(rows) / 2
    from tessera.llm.graph import components
    both = [components(e).where("component <> node").count() for e in (spark.createDataFrame(edges), member.selectExpr("class AS a", "center AS b"))]
    assert both[0] == both[1]
