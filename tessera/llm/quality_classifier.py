"""Quality classifier: hierarchical empirical Bayes over host and path.

1. Two logistic models (good quality, toxic) over hashed words and a few
   surface ratios are fitted on a bounded sample of labelled documents.
2. Every document is scored; that is the document's own evidence.
3. The scores are aggregated by path (host and path) and by host.  Paths are
   Beta distributed around their host and hosts around the whole corpus; the
   strengths of both priors come from the moments of the group means over all
   documents.  A sparse site is therefore drawn towards its host, a sparse host
   towards the corpus.
4. A document's score is its own log odds plus how far its path's posterior
   (without the document itself) lies from the corpus.

Only per-group sums are shuffled, combined before; the document scores are
written once, without texts.

Cases: a null text has no words and is scored by the models' constants; a null
host or path is a group of its own; repeated rows are scored one by one;
without labels of both kinds a model is constant (nothing is rejected by it);
an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.quality_rules import rule_counts
from tessera.llm.tables import written
from tessera.llm.textops import Slice, keyed_slices, mix64, text_slices

SAMPLE = 6_000        # labelled documents the models are fitted on, at most
BUCKETS = 1 << 22     # hashed words; a model keeps only those it uses
ROUNDS = 150
RIDGE = 1e-4          # of the mean log loss
LEAST_BETWEEN = 1e-4  # variance between groups, at least: a strength never exceeds mean * (1 - mean) / this
LEAST_DOCS = 5        # sample documents with a word bucket that is used, at least
DEVIATIONS = 5.0      # a word bucket is used if its share differs that much between the classes
N_RATIOS = 6


def _ratios(s: Slice) -> np.ndarray:
    """Surface ratios of each document: capitals, symbols, digits, word length, repeated words, repeated lines."""
    c = rule_counts(s)
    size = np.maximum(np.diff(s.offsets), 1)
    words = np.maximum(c["n_words"], 1)
    capital = s.per_doc_sum((s.data >= 65) & (s.data <= 90)) / size
    digit = s.per_doc_sum((s.data >= 48) & (s.data <= 57)) / size
    return np.column_stack([capital, c["n_symbols"] / size, digit, np.minimum(c["word_chars"] / words, 20) / 20, c["n_repeat_words"] / words, np.minimum(c["n_dup_lines"] / words, 1)])


def _present(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the different word buckets of each document."""
    bucket = (mix64(s.word_hashes()) % np.uint64(BUCKETS)).astype(np.int64)
    key = np.unique(s.word_doc * BUCKETS + bucket)
    return key // BUCKETS, key % BUCKETS


def _collector(ids: list[int]):
    def collect(batches):
        wanted = pa.array(ids, pa.int64())
        for batch in batches:
            mine = batch.filter(pc.is_in(batch.column(0), wanted, skip_nulls=True))
            for key, s in keyed_slices(mine):
                s.split_words()
                doc, bucket = _present(s)
                bound = np.searchsorted(doc, np.arange(s.n_docs + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([s.ids, key, pa.ListArray.from_arrays(pa.array(bound), pa.array(bucket.astype(np.int32))), pa.FixedSizeListArray.from_arrays(pa.array(_ratios(s).ravel()), N_RATIOS).cast(pa.list_(pa.float64()))], names=["doc_id", "text_key", "buckets", "ratios"])
    return collect


class Model:
    """Logistic model: a constant, a weight for some word buckets and for each surface ratio."""

    def __init__(self, constant: float, buckets: np.ndarray, words: np.ndarray, ratios: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.constant, self.buckets, self.words, self.ratios, self.mean, self.scale = constant, buckets, words, ratios, mean, scale

    def dense(self) -> np.ndarray:
        out = np.zeros(BUCKETS, np.float32)
        out[self.buckets] = self.words
        return out

    def log_odds(self, n_docs: int, doc: np.ndarray, word_weight: np.ndarray, ratios: np.ndarray) -> np.ndarray:
        return self.constant + np.bincount(doc, word_weight, minlength=n_docs) + ((ratios - self.mean) / self.scale) @ self.ratios


def fit(doc: np.ndarray, bucket: np.ndarray, ratios: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression by adaptive gradient steps, over the ratios and the word buckets that tell the classes apart."""
    n = len(y)
    if not n or y.min() == y.max():
        constant = 0.0 if not n else (20.0 if y[0] else -20.0)
        return Model(constant, np.zeros(0, np.int64), np.zeros(0), np.zeros(N_RATIOS), np.zeros(N_RATIOS), np.ones(N_RATIOS))
    mean, scale = ratios.mean(0), np.maximum(ratios.std(0), 1e-6)
    z = (ratios - mean) / scale
    with_word = np.bincount(bucket, minlength=BUCKETS)
    good = np.bincount(bucket, y[doc], minlength=BUCKETS)
    share = with_word / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / y.sum() + 1 / (n - y.sum())))
    telling = (np.abs(good / y.sum() - (with_word - good) / (n - y.sum())) >= DEVIATIONS * spread) & (with_word >= LEAST_DOCS)
    used = np.flatnonzero(telling)
    held = telling[bucket]
    doc, at = doc[held], np.searchsorted(used, bucket[held])
    k = len(used)
    # balanced classes: the rare one counts as much as the common one
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    w, v, m2 = (np.zeros(k + N_RATIOS + 1) for _ in range(3))
    for t in range(1, ROUNDS + 1):
        odds = np.bincount(doc, w[at], minlength=n) + z @ w[k:-1] + w[-1]
        r = weight * (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y)
        g = np.concatenate([np.bincount(at, r[doc], minlength=k), z.T @ r, [r.sum()]])
        g[:-1] += RIDGE * w[:-1]
        v, m2 = 0.9 * v + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w -= 0.1 * (v / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.99 ** t)) + 1e-8)
    return Model(float(w[-1]), used, w[:k], w[k:-1], mean, scale)


def fit_models(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model, Model]:
    """(quality, toxic) models from at most ``sample`` labelled documents, by hash order of their ids.

    Of rows that share an id, the one with the smallest text hash is fitted on.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").dropDuplicates(["doc_id"])
    rows = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    label = {r["doc_id"]: (r["quality"], r["toxic"]) for r in rows}
    found = texts.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(_collector(sorted(label)), "doc_id long, text_key long, buckets array<int>, ratios array<double>")
    got = found.groupBy("doc_id").agg(F.min_by(F.struct("buckets", "ratios"), "text_key").alias("one")).select("doc_id", "one.*").toArrow()  # one row for each id of the sample
    order = np.argsort(got["doc_id"].to_numpy(), kind="stable")
    got = got.take(pa.array(order)).combine_chunks()
    ids = got["doc_id"].to_pylist()
    doc = np.repeat(np.arange(len(ids)), pc.list_value_length(got["buckets"]).to_numpy())
    bucket = pc.list_flatten(got["buckets"]).to_numpy()
    ratios = pc.list_flatten(got["ratios"]).to_numpy().reshape(-1, N_RATIOS)
    return tuple(fit(doc, bucket, ratios, np.array([label[i][k] for i in ids], float)) for k in (0, 1))


def _scorer(quality: Model, toxic: Model):
    def score(batches):
        models = [(m, m.dense()) for m in (quality, toxic)]
        for batch in batches:
            at = 0
            for s in text_slices([batch]):
                s.split_words()
                doc, bucket = _present(s)
                ratios = _ratios(s)
                odds = [np.round(np.clip(m.log_odds(s.n_docs, doc, w[bucket], ratios), -20, 20), 6) for m, w in models]
                yield pa.RecordBatch.from_arrays([s.ids, *(batch.column(i).slice(at, s.n_docs) for i in (2, 3)), *map(pa.array, odds)], names=["doc_id", "host", "path", "quality_odds", "toxic_odds"])
                at += s.n_docs
    return score


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """One row per (host, path): sums, prior strengths and the host's posterior.  ``scored``: host, path, p."""
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"), F.sum("ss").alias("host_ss"))
    corpus = hosts.agg((F.sum("host_s") / F.sum("host_n")).alias("m"), F.sum("host_n").alias("all_n"))

    def strength(groups: DataFrame, n: str, s: str, ss: str, around: Column, name: str) -> DataFrame:
        """Beta strength from the variance between group means, sampling variance taken off."""
        mean, size = F.col(s) / F.col(n), F.col(n)
        inside = F.greatest(F.col(ss) / size - mean * mean, F.lit(0.0)) / size
        between = F.greatest(F.sum(size * ((mean - around) * (mean - around) - inside)) / F.sum(size), F.lit(LEAST_BETWEEN))
        centre = F.sum(size * mean) / F.sum(size)
        return groups.agg(F.greatest(centre * (1 - centre) / between - 1, F.lit(1.0)).alias(name))

    with_corpus = hosts.crossJoin(F.broadcast(corpus))  # one row
    host_strength = strength(with_corpus, "host_n", "host_s", "host_ss", F.col("m"), "k_host")
    host_post = with_corpus.crossJoin(F.broadcast(host_strength)).select(F.col("host").alias("h"), "m", "k_host", "host_n", "host_s", ((F.col("k_host") * F.col("m") + F.col("host_s")) / (F.col("k_host") + F.col("host_n"))).alias("host_mean"))
    joined = written(paths.join(host_post, F.col("host").eqNullSafe(F.col("h"))).drop("h"), "sites")
    path_strength = strength(joined, "n", "s", "ss", F.col("host_mean"), "k_path")
    return joined.crossJoin(F.broadcast(path_strength))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, evidence and site terms, quality and toxic chances, ``kept``."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    quality, toxic = fit_models(texts.select("doc_id", "text"), labels)
    scored = written(texts.mapInArrow(_scorer(quality, toxic), "doc_id long, host string, path string, quality_odds double, toxic_odds double"), "scores")
    scored = scored.withColumn("p", F.round(_chance(F.col("quality_odds")), 9))
    sites = site_posteriors(scored).withColumnsRenamed({"host": "h", "path": "q"})
    both = scored.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    p = F.col("p")
    others_of_host = (F.col("k_host") * F.col("m") + F.col("host_s") - p) / (F.col("k_host") + F.col("host_n") - 1)
    others_of_path = (F.col("k_path") * others_of_host + F.col("s") - p) / (F.col("k_path") + F.col("n") - 1)
    inside = lambda x: F.greatest(F.least(x, F.lit(1 - 1e-6)), F.lit(1e-6))
    site = F.round(_logit(inside(others_of_path)) - _logit(inside(F.col("m"))), 6)
    good, bad = F.round(_chance(F.col("quality_odds") + site), 6), F.round(_chance(F.col("toxic_odds")), 6)
    return both.select("doc_id", F.col("quality_odds").alias("evidence"), site.alias("site"), good.alias("quality"), bad.alias("toxic"), ((good >= 0.5) & (bad < 0.5)).alias("kept"))
