"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Two multinomials over hashed n-grams of ``GRAM`` bytes are counted: one over
every trusted document, one over every document.  A document's score is the
mean of log(p_trusted / p_raw) over its n-grams, each ratio drawn towards 1 by
``SHRINK`` counts so that rare n-grams say little; one threshold is applied to
every document: trusted mean minus ``Z`` trusted deviations, over every trusted
document, each scored by ratios that were fitted without its own fold (one of
``FOLDS``, by hash of the id).  Fixed rules on length and repetition come first.

The raw counts need no join.  For the trusted ones a Bloom filter of the trusted
ids thins the scan (``BITS_PER_ID`` bits an id, at most ``MAX_BITS``; where it is
too small for all ids more texts pass, never fewer), and what passes meets the
labels in a merge join, which decides: the same plan at every size, and no text
without a label is shuffled but for one in some hundred.

Cases: a null text has no words and fails the length rule; without trusted
documents the ratio is 0 everywhere and only the fixed rules decide; repeated
rows are judged each for itself and all count in the raw corpus.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import written
from tessera.llm.textops import IS_SPACE, cover, keyed_slices, mix64, repeats, text_slices

GRAM = 4                 # bytes of an n-gram: short enough that a document has many that the corpus knows well
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS  # hashed n-grams: the weights that are broadcast take 4 bytes each
FOLDS = 4               # of the trusted documents: the threshold is a statistic of scores fitted on the other folds
SHRINK = 10.0            # n-grams' worth of belief that a bucket is as common among the trusted as in the corpus
Z = 4.0                 # deviations below the trusted mean that are still kept
MIN_WORDS = 50
BITS_PER_ID = 16
MAX_BITS = 1 << 27      # of the Bloom filter: 16 MB, at 16 bits an id enough for eight million trusted ids

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _ngrams(s) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of each ``GRAM``-byte gram of a slice that lies in one document (white space counts as a blank)."""
    n = len(s.data) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.where(IS_SPACE[s.data], np.uint8(32), s.data)
    gram = np.zeros(n, np.uint32)
    for i in range(GRAM):
        gram = (gram << np.uint32(8)) | data[i:i + n]
    doc = np.repeat(np.arange(s.n_docs, dtype=np.int32), np.diff(s.offsets))
    inside = doc[:n] == doc[GRAM - 1:]
    bucket = (gram[inside] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    return doc[:n][inside], bucket.astype(np.int32)


def _fold(ids: pa.Array) -> np.ndarray:
    return (mix64(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)


def _count_raw(batches):
    raw = np.zeros(BUCKETS, np.int64)
    for s in text_slices(batches):
        raw += np.bincount(_ngrams(s)[1], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen])], names=["bucket", "raw"])


def _count_trusted(batches):
    good = np.zeros((FOLDS, BUCKETS), np.int64)
    for s in text_slices(batches):
        doc, bucket = _ngrams(s)
        fold = _fold(s.ids)[doc]
        for k in range(FOLDS):
            good[k] += np.bincount(bucket[fold == k], minlength=BUCKETS)
    seen = np.flatnonzero(good.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(seen), *map(pa.array, good[:, seen])], names=["bucket", *_GOOD])


def _bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """Three places in the bit array for each id, one row a hash."""
    h = ids.astype(np.int64).view(np.uint64)
    return np.array([mix64(h + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(bits) for k in range(3)]).astype(np.int64)


def bloom_filter(ids: DataFrame) -> np.ndarray:
    """Bit array (as bytes) of the ids in the only column; its size follows their number up to ``MAX_BITS``."""
    bits = 1 << 16
    while bits < min(MAX_BITS, BITS_PER_ID * ids.count()):
        bits *= 2

    def words(batches):
        for batch in batches:
            at = np.unique(_bits(batch.column(0).to_numpy(), bits))
            word, first = np.unique(at >> 6, return_index=True)
            value = np.bitwise_or.reduceat(np.left_shift(np.int64(1), at & 63), first) if len(first) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], names=["word", "value"])

    filled = ids.mapInArrow(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()  # at most MAX_BITS / 64 rows
    out = np.zeros(bits >> 6, np.int64)
    out[filled["word"].to_numpy()] = filled["value"].to_numpy()
    return out


def _thinned(filter_):
    def thin(batches):
        words = filter_.value
        for batch in batches:
            ids = batch.column(0)
            at = _bits(ids.fill_null(0).to_numpy(zero_copy_only=False), len(words) << 6)
            may = ((words[at >> 6] >> (at & 63)) & 1).all(0) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(may))
    return thin


_GOOD = [f"good{k}" for k in range(FOLDS)]
SCHEMA = "doc_id long, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, held_score double, score double"


def rule_counts(s) -> dict[str, np.ndarray]:
    """The fixed rules' counts for each document of a slice whose words are split."""
    chars = s.per_doc_sum(s.in_word & ((s.data & 0xC0) != 0x80))
    doc, a, b = s.lines()
    has_word = np.searchsorted(s.starts, a) < np.searchsorted(s.starts, b)
    doc, a, b = doc[has_word], a[has_word], b[has_word]
    _, again = repeats(s.byte_hash(a, b) ^ mix64(doc.astype(np.uint64) + np.uint64(1)))
    at, three = s.windows(s.word_hashes(), 3)
    found_twice, _ = repeats(three ^ mix64(s.word_doc[at].astype(np.uint64) + np.uint64(1)))
    in_repeat = cover(len(s.starts), at[found_twice], 3)
    return {"n_words": s.n_words, "word_chars": chars, "n_symbols": s.per_doc_sum(_SYMBOL[s.data]), "n_dup_lines": np.bincount(doc[again], minlength=s.n_docs), "n_repeat_words": np.bincount(s.word_doc[in_repeat], minlength=s.n_docs)}


def _scorer(weights: np.ndarray, held: np.ndarray):
    def score(batches):
        for key, s in ((key, s) for batch in batches for key, s in keyed_slices(batch)):
            s.split_words()
            c = rule_counts(s)
            doc, bucket = _ngrams(s)
            grams = np.maximum(np.bincount(doc, minlength=s.n_docs), 1)
            mean = [np.round(np.bincount(doc, w, minlength=s.n_docs) / grams, 6) for w in (held[_fold(s.ids)[doc], bucket], weights[bucket])]
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
            yield pa.RecordBatch.from_arrays([s.ids, key, *(pa.array(c[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), pa.array(failed), *map(pa.array, mean)], names=["doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "held_score", "score"])
    return score


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the labelled documents of good quality that aren't toxic."""
    return labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def log_ratios(docs: DataFrame, trusted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each bucket from all trusted documents, and, by fold, from those of the other folds; the raw counts are taken over every document."""
    texts = docs.select("doc_id", "text")
    trusted = written(trusted, "trusted")
    filter_ = docs.sparkSession.sparkContext.broadcast(bloom_filter(trusted))
    labelled = texts.mapInArrow(_thinned(filter_), "doc_id long, text string").join(trusted.hint("merge"), "doc_id", "left_semi")
    raw, folds = np.zeros(BUCKETS, np.int64), np.zeros((FOLDS, BUCKETS), np.int64)
    of_all = texts.mapInArrow(_count_raw, "bucket long, raw long").groupBy("bucket").agg(F.sum("raw").alias("raw")).toArrow()  # at most BUCKETS rows
    raw[of_all["bucket"].to_numpy()] = of_all["raw"].to_numpy()
    of_trusted = labelled.mapInArrow(_count_trusted, ", ".join(f"{c} long" for c in ("bucket", *_GOOD))).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in _GOOD)).toArrow()
    for k, c in enumerate(_GOOD):
        folds[k, of_trusted["bucket"].to_numpy()] = of_trusted[c].to_numpy()

    def weights(good: np.ndarray) -> np.ndarray:
        out = np.zeros(BUCKETS)
        if good.sum():
            expected = raw * (good.sum() / raw.sum())
            seen = raw > 0
            out[seen] = np.log((good[seen] + SHRINK) / (expected[seen] + SHRINK))
        return out.astype(np.float32)

    return weights(folds.sum(0)), np.array([weights(folds.sum(0) - mine) for mine in folds])


def _judged(texts: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(written score table, its one-row threshold) of (doc_id, text, text_key)."""
    trusted = trusted_ids(labels)
    scored = written(texts.mapInArrow(_scorer(*log_ratios(texts, trusted)), SCHEMA), "quality_rules")
    of_trusted = scored.where("NOT base_failed").select("doc_id", "held_score").join(trusted, "doc_id", "left_semi")
    return scored, of_trusted.agg(F.round(F.avg("held_score") - Z * F.stddev_pop("held_score"), 6).alias("threshold"))


def _kept() -> Column:
    return ~F.col("base_failed") & F.coalesce(F.col("score") >= F.col("threshold"), F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the rule counts, the score and ``kept``.

    Three scans of the texts (raw counts, trusted counts, scores); the score
    table (numbers only) is written once because the threshold is a statistic of
    it.
    """
    scored, limit = _judged(_texts(docs, id_col, text_col), labels)
    return scored.crossJoin(F.broadcast(limit)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", _kept().alias("kept"), "score", "threshold")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), F.xxhash64(docs[text_col].cast("string")).alias("text_key"))


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are rejected (a verdict depends on the text, so equal rows share theirs)."""
    scored, limit = _judged(_texts(docs, id_col, text_col), labels)
    out = scored.crossJoin(F.broadcast(limit)).where(~_kept()).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t")).distinct()
    mine = F.col(id_col).cast("long").eqNullSafe(F.col("__d")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__t"))
    return docs.join(out, mine, "left_anti")
