import hashlib

import pytest
from fixtures import sample, words
from pyspark.sql import functions as F

from tessera.llm import substring_dedup as sd


def results(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def plain(docs, window=20):
    """Sorted results, row by row; a null id comes first, rows of one id stand by their text's hash."""
    rows = [(r.doc_id is not None, r.doc_id or 0, r.key, r.text) for r in docs.select("doc_id", "text", F.xxhash64("text").alias("key")).collect()]
    first = {}
    for *place, t in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            k = tuple(w[j:j + window])
            first[k] = min(first.get(k, (*place, j)), (*place, j))
    out = []
    for *place, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < (*place, j):
                gone[j:j + window] = [True] * window
        out.append((*place[:2], len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [1, 2048])
def test_equals_brute_force(spark, monkeypatch, hot):
    """With the automata, and with every anchor that has two contents taken as hot."""
    monkeypatch.setattr(sd, "HOT_CONTENTS", hot)
    docs = sample(spark)
    w = " ".join(f"w{k}" for k in range(30))
    more = [(1000, w), (1001, f"x {w}"), (1002, f"{w} {w}"), (1003, "same " * 70), (1004, "y " + "same " * 25), (1005, " ".join(f"w{k}" for k in range(5, 25))), (1006, None)]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    want = plain(docs)
    assert results(sd.dedup(docs)) == want and sum(x[3] for x in want) > 500


def test_kept_text(spark):
    w = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, w), (2, f"a {w} b"), (3, "c  d")], "doc_id long, text string")
    got = {r.doc_id: r.kept for r in sd.dedup(docs, keep_text=True).collect()}
    assert got == {1: None, 2: "a b", 3: None}


def test_automaton_statistics():
    a = sd.Automaton()
    a.add([1, 2, 3, 4, 1, 2], 0)
    a.add([9, 2, 3, 4, 9], 6)
    assert a.matches([2, 3, 4], 3) == [3]
    assert a.matches([5, 1, 2, 7], 2) == [-1, 1, -1]
    assert a.matches([3, 4, 9], 3) == [10]


@pytest.mark.parametrize("hot", [1, 2048])
def test_repeated_rows_and_shared_ids(spark, monkeypatch, hot):
    """Rows without an id, rows repeated whole and ids with several texts, on both paths."""
    import random
    monkeypatch.setattr(sd, "HOT_CONTENTS", hot)
    r = random.Random(7)
    passages = [" ".join(r.choice("abcdefgh") + str(r.randint(0, 40)) for _ in range(45)) for _ in range(4)]
    frame = "start " + " ".join(f"c{k}" for k in range(24))  # an anchor with very many contents
    rows = []
    for k in range(90):
        own = " ".join(f"{r.choice('xyz')}{r.randint(0, 400)}" for _ in range(r.randint(0, 40)))
        rows.append((None if k % 3 == 0 else k // 5, f"{own} {r.choice(passages)} {frame} {own[:20]} {k % 7}"))
    rows += rows[:30] + rows[:10]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(docs)
    assert results(sd.dedup(docs)) == want and sum(x[3] for x in want) > 500


def test_rows_without_an_id_share_no_list(spark):
    """The lists of a row's segments hold its own text's segments only, however many rows have no id."""
    rows = [(None, f"{k} " + " ".join(f"w{j}" for j in range(40)) + f" {k}") for k in range(300)]
    texts = spark.createDataFrame([(sd.NULL_ID, t, k) for k, (_, t) in enumerate(rows)], "doc_id long, text string, text_key long")
    spans = sd.repeated_spans(texts).groupBy("doc_id", "text_key").count()
    assert spans.agg({"count": "max"}).first()[0] <= 41
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert results(sd.dedup(docs)) == plain(docs)
