import random
from collections import Counter, defaultdict

import pytest
from fixtures import sample, words
from pyspark.sql import functions as F

from tessera.llm import source_mix as sm


def targets(sizes):
    """Plain water filling: source -> target."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in stopped]
        share = (left - sum(stopped.values())) / max(sum(weight[s] for s in open_), 1)
        over = [s for s in open_ if weight[s] * share >= 2 * sizes[s]]
        if not over:
            return stopped | {s: weight[s] * share for s in open_}
        stopped |= {s: 2.0 * sizes[s] for s in over}


def mixed_docs(spark):
    r = random.Random(4)
    docs = sample(spark).select("doc_id", "text", "source")
    more = [(1000 + k, " ".join("w" * 3 for _ in range(r.randint(0, 40))), r.choice([None, "é", "Z", "a", "tiny"])) for k in range(80)]
    return docs.union(spark.createDataFrame([*more, (2000, None, "empty")], docs.schema))


def test_targets_and_words_taken(spark):
    docs = mixed_docs(spark)
    rows = docs.collect()
    size, source = Counter(), {}
    for x in rows:
        size[x.source] += len(words(x.text))
        source[x.doc_id] = x.source
    want = targets(dict(size))
    got = sm.taken_words(docs).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for g in got:
        s = source[g.doc_id]
        assert g.source_size == size[s] and abs(g.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= g.taken <= 2 * g.size
        taken[s] += g.taken
    assert all(taken[s] == int(want[s] + 1e-9) or abs(taken[s] - want[s]) <= 1 for s in size)
    again = {g.doc_id: g.taken for g in sm.taken_words(docs.repartition(7)).collect()}
    assert again == {g.doc_id: g.taken for g in got}


@pytest.mark.parametrize("fan", [2, 64])
def test_shards_are_exact_and_disjoint(spark, monkeypatch, fan):
    """One level of sources, and groups of groups of two."""
    monkeypatch.setattr(sm, "FAN", fan)
    _, draws = sm.mix(mixed_docs(spark), shard_blocks=50)
    rows = draws.collect()
    per = defaultdict(list)
    for x in rows:
        per[x.shard].append(x.position)
    sizes = sorted(map(len, per.values()))
    assert sizes[-1] - sizes[0] <= 1 and all(sorted(p) == list(range(len(p))) for p in per.values())
    keys = [(x.doc_id, x.text_key, x.copy, x["pass"]) for x in rows]
    assert len(set(keys)) == len(keys)


def test_hypergeometric_law(spark):
    import math
    n, k, m = 20, 7, 9
    got = Counter(r.x for r in spark.range(20_000).select(sm.hypergeometric(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(m).cast("long"), (F.col("id") + 0.5) / 20_000).alias("x")).collect())
    for x in range(0, 8):
        p = math.comb(k, x) * math.comb(n - k, m - x) / math.comb(n, m)
        assert abs(got[x] / 20_000 - p) < 1e-3
    big = spark.range(1).select(sm.hypergeometric(F.lit(10**9).cast("long"), F.lit(3 * 10**8).cast("long"), F.lit(10**6).cast("long"), F.lit(0.5)).alias("x")).first().x
    assert abs(big - 300_000) < 5


def test_mixed_documents(spark):
    docs = mixed_docs(spark)
    got = sm.taken_words(docs).agg(F.sum("taken")).first()[0]
    out = sm.mixed_documents(docs)
    assert out.columns == docs.columns
    assert sum(len(words(r.text)) for r in out.collect()) == got
