import numpy as np
from fixtures import sample  # noqa: F401

from tessera.llm import permutation_index as pi


def plain(vectors, every=20, k=20):
    ids = np.array([i for i, _ in vectors])
    x = np.array([v for _, v in vectors], np.float64)
    out = {}
    for i, v in zip(ids, x):
        if i % every == 0:
            score = x @ v
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def frame(spark, vectors):
    return spark.createDataFrame([(int(i), [float(c) for c in v], 0) for i, v in vectors], "vec_id long, embedding array<float>, label int")


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(pi, "SHARD_ROWS", 1500)
    monkeypatch.setattr(pi, "QUERY_ROWS", 100)
    monkeypatch.setattr(pi, "MIN_RERANK", 32)
    rng = np.random.default_rng(1)
    vectors = [(i, v.astype(np.float32)) for i, v in enumerate(rng.normal(size=(4000, 24)) * rng.uniform(0.5, 1.5, (4000, 1)))]
    got, want = collected(pi.nearest(frame(spark, vectors))), plain(vectors)
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    x = dict(vectors)
    for q, found in got.items():
        assert len(found) == 20 and all(v != q for v, _ in found)
        assert all(abs(s - float(x[q].astype(float) @ x[v].astype(float))) < 1e-12 for v, s in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)


def test_ties_repeats_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=4).astype(np.float32)
    vectors = [(i, hot if i % 3 else rng.normal(size=4).astype(np.float32)) for i in range(150)]
    rows = [(int(i), [float(c) for c in v]) for i, v in vectors]
    odd = [(500, None), (520, [0.0] * 4), (540, [1.0, None, 1.0, 1.0]), (560, [float("nan"), 1.0, 1.0, 1.0]), (580, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (600, [1.0]), rows[40]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got, want = collected(pi.nearest(df)), plain(vectors)
    assert got.keys() == want.keys()
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_fewer_candidates_than_asked(spark):
    got = collected(pi.nearest(frame(spark, [(0, [1, 0]), (7, [1, 1]), (9, [-1, 0])])))
    assert [v for v, _ in got[0]] == [7, 9]


def test_footrule_ranks_like_the_full_distance():
    rng = np.random.default_rng(3)
    perms = np.array([rng.permutation(12)[:5] for _ in range(50)]).astype(np.int16)
    files = pi.InvertedFiles(perms, 12)
    place = lambda p, x: list(p).index(x) if x in p else 5
    q = perms[0]
    far = np.array([sum(abs(place(q, x) - place(p, x)) for x in range(12)) for p in perms])
    near = files.similarity(q)
    assert (far == 2 * (near.max() - near)).all()
