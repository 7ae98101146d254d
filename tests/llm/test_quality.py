import re
from collections import Counter

from fixtures import sample, words

from tessera.llm import quality_classifier as qc
from tessera.llm import quality_rules as qr
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def plain(t):
    t = t or ""
    w = words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    three = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if three[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_rule_counts_equal_brute_force(spark):
    more = ["a b c a b c", "x\nx\n x\nx \n\n\n", "# * | é ü 日本　語", "", None, "a\x0bb\x0cc", "a a a a"]
    docs = sample(spark, SF).select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in qr.judge(docs, labels).collect()}
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == plain(r.text), r.doc_id
        assert not (g.base_failed and g.kept)


def test_verdicts_agree_with_held_out_labels(spark):
    """The trusted multinomial is fitted on half of the good documents; the others must be judged alike."""
    docs, labels = sample(spark, "/root/testdata/sf0.1"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    got = qr.judge(docs, half).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed")
    good = got.where("quality = 1")
    assert good.where("kept").count() >= 0.98 * good.count()
    bad = got.where("quality = 0")
    assert bad.where("kept").count() <= 0.1 * bad.count()


def test_kept_documents(spark):
    docs, labels = sample(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    want = {r.doc_id for r in qr.judge(docs, labels).where("kept").collect()}
    assert {r.doc_id for r in qr.kept_documents(docs, labels).collect()} == want


def test_without_trusted_documents(spark):
    docs, labels = sample(spark), spark.read.parquet(f"{SF}/labels.parquet").limit(0)
    assert qr.judge(docs, labels).where("kept = base_failed").count() == 0


def test_classifier_on_held_out_labels(spark):
    docs, labels = sample(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    got = qc.classify(docs, labels.where("doc_id % 2 = 0"), F.col("source"), F.col("lang")).join(labels.where("doc_id % 2 = 1").withColumnRenamed("quality", "good").withColumnRenamed("toxic", "rude"), "doc_id")
    n = got.count()
    assert got.where("(quality >= 0.5) = (good = 1)").count() >= 0.95 * n
    clean = got.where("good = 1 AND rude = 0")
    assert clean.where("kept").count() >= 0.97 * clean.count()


def test_sparse_sites_shrink(spark):
    rows = [("big", "p", 0.9)] * 200 + [("big", "q", 0.8)] * 100 + [("other", "r", 0.3)] * 200 + [("big", "new", 0.1), ("tiny", "x", 0.1)]
    sites = {(r.host, r.path): r for r in qc.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    post = lambda r: (r.k_path * r.host_mean + r.s) / (r.k_path + r.n)
    assert post(sites["big", "new"]) > 0.1  # one document is drawn to its host
    assert sites["tiny", "x"].host_mean > 0.11  # and its host to the corpus
    assert abs(post(sites["big", "p"]) - 0.9) < 0.02  # many documents speak for themselves


def test_models_without_both_classes():
    import numpy as np
    none = np.zeros(0, np.int64)
    ratios = np.zeros((3, qc.N_RATIOS))
    assert qc.fit(none, none, ratios, np.ones(3)).constant > 0
    assert qc.fit(none, none, ratios, np.zeros(3)).constant < 0
    assert qc.fit(none, none, ratios[:0], np.zeros(0)).constant == 0


def test_every_trusted_document_counts(spark):
    """All labels take part in the ratios, and the threshold is that of scores fitted without a document's own fold."""
    import numpy as np

    from tessera.llm.textops import mix64
    docs, labels = sample(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    grown = labels.union(spark.range(20_000_000, 20_012_000).selectExpr(*(f"{'id' if c == 'doc_id' else 1 - (c == 'toxic')} AS {c}" for c in labels.columns)))
    good = sorted({r.doc_id for r in labels.where("quality = 1 AND toxic = 0").collect()} & set(texts))
    fold = dict(zip(good, (mix64(np.array(good, np.uint64)) % np.uint64(qr.FOLDS)).tolist(), strict=True))
    grams = {}
    for i, t in texts.items():
        raw = re.sub(rb"[\x09-\x0d]", b" ", t.encode())
        grams[i] = np.array([(int.from_bytes(raw[k:k + 4], "big") * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - qr.BUCKET_BITS for k in range(len(raw) - 3)], np.int64)
    count = lambda ids: np.bincount(np.concatenate([grams[i] for i in ids]), minlength=qr.BUCKETS)
    every = count(texts)
    held = []
    for k in range(qr.FOLDS):
        mine = count([i for i in good if fold[i] != k])
        ratio = np.log((mine + qr.SHRINK) / (every * (mine.sum() / every.sum()) + qr.SHRINK))
        held += [ratio[grams[i]].mean() for i in good if fold[i] == k and not plain(texts[i])[-1]]
    for given in (labels, grown):
        limit = qr.judge(docs, given).first().threshold
        assert abs(limit - (np.mean(held) - qr.Z * np.std(held))) < 1e-4


def test_repeated_rows_are_fitted_on_once(spark):
    import numpy as np
    docs, labels = sample(spark, SF).select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")
    one = labels.where("quality = 0").agg(F.min("doc_id")).first()[0]
    again = docs.union(docs.where(F.col("doc_id") == one).crossJoin(spark.range(300)).select("doc_id", "text"))
    for a, b in zip(qc.fit_models(docs, labels), qc.fit_models(again, labels), strict=True):
        assert a.constant == b.constant and all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("buckets", "words", "ratios", "mean", "scale"))


def test_sites_of_one_to_three_documents_beside_a_large_host(spark):
    import math
    docs, labels = sample(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    host = F.when(F.col("doc_id") % 3 == 0, F.lit("big")).otherwise(F.concat(F.lit("h"), (F.col("doc_id") / 4).cast("long")))
    path = F.concat(F.lit("p"), F.col("doc_id") % 2)
    site = {r.doc_id: (r.h, r.p) for r in docs.select("doc_id", host.alias("h"), path.alias("p")).collect()}
    got = {r.doc_id: r for r in qc.classify(docs, labels, host, path).collect()}
    p = {i: round(1 / (1 + math.exp(-r.evidence)), 9) for i, r in got.items()}
    hosts, paths = {}, {}
    for i, (h, q) in site.items():
        hosts.setdefault(h, []).append(p[i])
        paths.setdefault((h, q), []).append(p[i])
    assert len(got) == len(site) and {len(v) for h, v in hosts.items() if h != "big"} <= {1, 2, 3} and 3 * len(hosts["big"]) >= len(site) - 3
    m = sum(p.values()) / len(p)

    def strength(groups, around):
        n = sum(map(len, groups.values()))
        mean = {g: sum(v) / len(v) for g, v in groups.items()}
        inside = {g: max(sum(x * x for x in v) / len(v) - mean[g] ** 2, 0) / len(v) for g, v in groups.items()}
        between = max(sum(len(v) * ((mean[g] - around(g)) ** 2 - inside[g]) for g, v in groups.items()) / n, qc.LEAST_BETWEEN)
        return max(m * (1 - m) / between - 1, 1)

    k_host = strength(hosts, lambda g: m)
    k_path = strength(paths, lambda g: (k_host * m + sum(hosts[g[0]])) / (k_host + len(hosts[g[0]])))
    logit = lambda x: math.log(x / (1 - x))
    inside = lambda x: max(min(x, 1 - 1e-6), 1e-6)
    for i, (h, q) in site.items():
        of_host = (k_host * m + sum(hosts[h]) - p[i]) / (k_host + len(hosts[h]) - 1)
        of_path = (k_path * of_host + sum(paths[h, q]) - p[i]) / (k_path + len(paths[h, q]) - 1)
        want = logit(inside(of_path)) - logit(inside(m))
        assert abs(got[i].site - want) < 1e-4 and abs(got[i].quality - 1 / (1 + math.exp(-(got[i].evidence + want)))) < 1e-4
