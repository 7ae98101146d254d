"""Line dedup: repeated runs of lines by distributed prefix doubling.

A document is its sequence of lines with a word (lines are equal if their
words are).  A line run of at least ``min_words`` words that also starts
earlier (smaller doc_id, or the same document and an earlier line) is a later
copy, and its lines are deleted.  The default takes every run: a line of one
word already counts, so every line whose words stand on an earlier line goes.

Prefix doubling names every run of 2**j lines by its first place in the
corpus: runs of one line from the lines' hashes, then runs of 2k lines from the
pairs (name of the first k, name of the next k).  Runs whose name is theirs
alone leave at once, so later rounds hold repeated text only.  A name is the
head of a suffix-array interval whose longest common prefix is at least that
many lines.  A maximal repeated run is the union of the shortest runs with
``min_words`` words that start, or end, at each of its lines; such a run of k
lines is named by its first and its last 2**j lines (2**j <= k < 2**(j+1)), so
doubling stops at ``min_words`` lines.  With ``min_words`` 1 the shortest runs
are single lines, and the intervals of one common line decide the deletions.

``maximal_runs`` builds the whole suffix array of the repeated lines: a rank is
the number of smaller suffixes, and a round orders the suffixes that still share
a rank by the rank of the suffix 2**j lines on (prefix sums over the different
pairs, cut into value ranges).  A suffix ends before a line that stands only
once and at its document's end.  The ranks of all rounds then give the longest
common prefix of neighbours in the array by halving steps.  The larger of its
two is the longest run at a line that stands elsewhere too (in another document
or, overlapping or not, in its own); it is maximal where the run of the line
before doesn't hold it.  What is deleted is what maximal runs hold of later copies
(each repeated run lies in a maximal one).  ``report`` counts the maximal runs (``n_runs``)
and gives the longest one's lines (``longest_run``; 0: none) of each document.

Cases: a null text has no lines and stays null; lines without words are never
deleted; a null doc_id comes before all others; rows equal in doc_id and text
count as one document (each loses the same lines); an empty table gives an
empty result.  Lines are compared by 64-bit hashes of their words.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.tables import written
from tessera.operators.ordered import ordered_prefix_sum
from tessera.llm.textops import RangeHash, Slice, _WORD_MULT, cover, slices

MIN_WORDS = 1
#: Rows of one value range of a prefix sum: what a task sorts at once.
RANGE_ROWS = 1 << 18
NULL_ID = -(1 << 63)


def _worded_lines(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start byte, end byte, first word, end word) of the lines with a word."""
    doc, a, b = s.lines()
    lo, hi = np.searchsorted(s.starts, a), np.searchsorted(s.starts, b)
    has = lo < hi
    return doc[has], a[has], b[has], lo[has], hi[has]


def _needed(words: np.ndarray, first: np.ndarray, last: np.ndarray, least: int) -> np.ndarray:
    """How many lines from each line on hold ``least`` words (0: too few lines in its document)."""
    total = np.concatenate([[0], np.cumsum(words)])
    i = np.arange(len(words))
    end = np.searchsorted(total, total[i] + least)
    return np.where(end <= last, end - i, 0)


def _emit_lines(min_words: int):
    def emit(batches):
        for batch in batches:
            at = 0
            for s in slices(batch.column(0), batch.column(1)):
                s.split_words()
                words = s.word_hashes()
                doc, _, _, lo, hi = _worded_lines(s)
                first = np.searchsorted(doc, np.arange(s.n_docs + 1))
                mine = np.arange(len(doc))
                n = hi - lo
                from_here = _needed(n, first[doc], first[doc + 1], min_words)
                to_here = _needed(n[::-1], len(doc) - first[doc + 1][::-1], len(doc) - first[doc][::-1], min_words)[::-1]
                ids = s.ids.to_numpy()
                keys = batch.column(2).slice(at, s.n_docs).to_numpy()
                at += s.n_docs
                h = RangeHash(words, _WORD_MULT)(lo, hi).view(np.int64) if len(lo) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(keys[doc]), pa.array((mine - first[doc]).astype(np.int32)), pa.array(h), pa.array(from_here.astype(np.int32)), pa.array(to_here.astype(np.int32))], names=["doc_id", "text_key", "line", "h", "from_here", "to_here"])
    return emit


_AT = ["doc_id", "text_key", "line"]


def _place():
    return F.struct(*_AT)


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys occur at two places or more, with ``name``: the first of them.

    The names are written, so that the join is a plain one, of which Spark splits the hot keys.
    """
    places = rows.groupBy(*keys).agg(F.min(_place()).alias("name"), F.max(_place()).alias("other")).where("name <> other").select(*keys, "name")
    return rows.join(written(places, "places"), keys)


def _shifted(names: DataFrame, by, alias: str) -> DataFrame:
    """Names as of a line ``by`` lines earlier."""
    return names.select("doc_id", "text_key", (F.col("line") - by).alias("line"), F.col("name").alias(alias))


def repeated_lines(texts: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The lines that stand at two places or more, with ``name``, the first of them, and the lines that ``min_words`` words take."""
    lines = written(texts.mapInArrow(_emit_lines(min_words), "doc_id long, text_key long, line int, h long, from_here int, to_here int"), "lines")
    return written(_named(lines, ["h"]).select(*_AT, "h", "name", "from_here", "to_here").dropDuplicates(_AT), "names")


def repeated_runs(base: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, start, k): shortest runs of lines with ``min_words`` words that also start earlier."""
    if min_words <= 1:
        return base.where(F.col("name") < _place()).select("doc_id", "text_key", F.col("line").alias("start"), F.lit(1).alias("k"))
    runs = F.array(F.struct(F.col("line").alias("start"), F.col("from_here").alias("k")), F.struct((F.col("line") - F.col("to_here") + 1).alias("start"), F.col("to_here").alias("k")))
    wanted = written(base.select("doc_id", "text_key", F.explode(runs).alias("r")).select("doc_id", "text_key", "r.start", "r.k").where("k > 0").distinct(), "runs")
    names, size, levels = base.select(*_AT, "name"), 1, []
    while True:
        of_size = wanted.where((F.col("k") >= size) & (F.col("k") < 2 * size))
        head = names.select("doc_id", "text_key", F.col("line").alias("start"), F.col("name").alias("head"))
        tail = names.select("doc_id", "text_key", F.col("line").alias("last"), F.col("name").alias("tail"))
        levels.append(of_size.join(head, ["doc_id", "text_key", "start"]).withColumn("last", F.col("start") + F.col("k") - size).join(tail, ["doc_id", "text_key", "last"]).select("doc_id", "text_key", F.col("start").alias("line"), "k", "head", "tail"))
        if 2 * size > min_words:
            break
        pairs = names.join(_shifted(names, size, "next"), _AT)
        names, size = written(_named(pairs.select(*_AT, F.col("name").alias("head"), "next"), ["head", "next"]).select(*_AT, "name"), "names"), 2 * size
    found = _named(reduce(DataFrame.unionByName, levels), ["k", "head", "tail"])
    return found.where(F.col("name") < _place()).select("doc_id", "text_key", F.col("line").alias("start"), "k")


def _numbered(base: DataFrame) -> DataFrame:
    """(place, at, h): ``at`` numbers the lines in corpus order, with a gap after each document."""
    docs = written(base.groupBy("doc_id", "text_key").agg((F.max("line").cast("long") + 2).alias("n")), "documents")
    first = ordered_prefix_sum(docs, ["doc_id", "text_key"], "n", "first", rows_per_range=RANGE_ROWS).select("doc_id", "text_key", "first")
    return written(base.join(first, ["doc_id", "text_key"]).select(*_AT, (F.col("first") + F.col("line")).alias("at"), "h"), "numbered")


def _ranked(lines: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Suffix ranks (at, rank) of the numbered lines, and per round the (at, rank) that share 2**round lines with another.

    Suffixes equal up to their end share a rank.
    """
    groups = written(lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")), "groups")
    start = ordered_prefix_sum(groups, ["h"], "n", "rank", rows_per_range=RANGE_ROWS).select("h", "rank")
    shared = written(lines.select("at", "h").join(start, "h").select("at", "rank"), "ranks")
    size, done, levels = 1, [], []
    while True:
        levels.append(shared)
        ranks = reduce(DataFrame.unionByName, [shared.withColumn("live", F.lit(True)), *(d.withColumn("live", F.lit(False)) for d in done)])
        further = ranks.select((F.col("at") - size).alias("at"), F.col("rank").alias("second"), "live")
        pairs = written(shared.join(further, "at", "left").select("at", "rank", F.coalesce("second", F.lit(-1)).alias("second"), F.coalesce("live", F.lit(False)).alias("live")), "pairs")
        groups = written(pairs.groupBy("rank", "second").agg(F.count(F.lit(1)).alias("n")), "groups")
        before = written(ordered_prefix_sum(groups, ["second"], "n", "before", ["rank"], RANGE_ROWS), "groups")
        refined = written(pairs.join(before, ["rank", "second"]).select("at", (F.col("rank") + F.col("before")).alias("rank"), (F.col("live") & (F.col("n") > 1)).alias("live")), "ranks")
        done.append(refined.where("NOT live").select("at", "rank"))
        shared, size = refined.where("live").select("at", "rank"), 2 * size
        if shared.isEmpty():
            return reduce(DataFrame.unionByName, done), levels


def maximal_runs(base: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, k): maximal runs of k lines that also stand elsewhere, by the suffix array of ``repeated_lines``."""
    lines = _numbered(base)
    ranks, levels = _ranked(lines)
    order = written(ordered_prefix_sum(ranks.withColumn("one", F.lit(1)), ["rank", "at"], "one", "i", rows_per_range=RANGE_ROWS).select("i", "at"), "suffixes")
    common = written(order.join(order.select((F.col("i") - 1).alias("i"), F.col("at").alias("next")), "i").select("at", "next", F.lit(0).cast("long").alias("lcp")), "neighbours")
    for j in reversed(range(len(levels))):
        a = levels[j].select(F.col("at").alias("a"), F.col("rank").alias("rank_a"))
        b = levels[j].select(F.col("at").alias("b"), F.col("rank").alias("rank_b"))
        both = common.withColumn("a", F.col("at") + F.col("lcp")).join(a, "a", "left").withColumn("b", F.col("next") + F.col("lcp")).join(b, "b", "left")
        common = written(both.select("at", "next", (F.col("lcp") + F.when(F.col("rank_a") == F.col("rank_b"), 1 << j).otherwise(0)).alias("lcp")), "neighbours")
    longest = common.select(F.explode(F.array("at", "next")).alias("at"), "lcp").groupBy("at").agg(F.max("lcp").alias("k"))
    by_place = Window.partitionBy("doc_id", "text_key").orderBy("line")  # within a document, which is one row of the input
    before = F.when(F.lag("line").over(by_place) == F.col("line") - 1, F.lag("k").over(by_place))
    return lines.join(longest, "at").withColumn("before", before).where("before IS NULL OR before <= k").select(*_AT, "k")


def _covered(runs: pa.Array, first: np.ndarray) -> np.ndarray:
    """Which lines the runs of the documents hold; ``first``: each document's first line, and the number of lines."""
    flat, held = runs.flatten(), np.zeros(first[-1], bool)
    if len(flat):
        of = np.repeat(np.arange(len(runs)), runs.value_lengths().fill_null(0).to_numpy())
        start, k = first[of] + flat.field("start").to_numpy(), flat.field("k").to_numpy()
        for size in np.unique(k):
            held |= cover(len(held), start[k == size], int(size))
    return held


def _delete(batches):
    for batch in batches:
        at = 0
        for s in slices(batch.column(0), batch.column(1)):
            s.split_words()
            doc, a, b, lo, hi = _worded_lines(s)
            first = np.searchsorted(doc, np.arange(s.n_docs + 1))
            copies, maximal = (batch.column(c).slice(at, s.n_docs) for c in (2, 6))
            nulls = batch.column(1).slice(at, s.n_docs).is_null().to_numpy(zero_copy_only=False)
            at += s.n_docs
            gone = _covered(copies, first) & _covered(maximal, first)
            n_gone = np.bincount(doc[gone], minlength=s.n_docs)
            w_gone = np.bincount(doc[gone], (hi - lo)[gone], minlength=s.n_docs).astype(np.int64)
            raw, texts = s.data.tobytes(), []
            for d in range(s.n_docs):
                text = raw[s.offsets[d]:s.offsets[d + 1]]
                if n_gone[d]:
                    pieces, x = [], s.offsets[d]
                    mine = np.flatnonzero(gone[first[d]:first[d + 1]]) + first[d]
                    for p, q in zip(a[mine].tolist(), b[mine].tolist(), strict=True):  # the line and its line end
                        pieces.append(raw[x:p])
                        x = q + 1
                    pieces.append(raw[x:s.offsets[d + 1]] if x <= s.offsets[d + 1] else b"")
                    text = b"".join(pieces)
                    if x > s.offsets[d + 1] and text.endswith(b"\n"):  # the last line went: so does the line end before it
                        text = text[:-1]
                texts.append(None if nulls[d] else text.decode())
            of_rows = [batch.column(c).slice(at - s.n_docs, s.n_docs) for c in (3, 4, 5)]
            yield pa.RecordBatch.from_arrays([s.ids, *of_rows, pa.array(np.diff(first).astype(np.int64)), pa.array(n_gone.astype(np.int64)), pa.array(s.n_words.astype(np.int64)), pa.array(w_gone), pa.array(texts, pa.string())], names=["doc_id", "row", "n_runs", "longest_run", "n_lines", "n_removed", "n_words", "n_removed_words", "text"])


def delete_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, ``row`` (its other columns), counts of lines and words and of those deleted, the text
    that is left, ``n_runs`` and ``longest_run`` of the maximal repeated runs."""
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("doc_id"), docs[text_col].cast("string").alias("text"), F.xxhash64(docs[text_col].cast("string")).alias("text_key"), F.struct(*(docs[c] for c in others), F.lit(0).alias("__none")).alias("row"))
    base = repeated_lines(rows.select("doc_id", "text", "text_key"), min_words)
    none = F.lit(None).cast("struct<start:int,k:long>")
    copies = repeated_runs(base, min_words).select("doc_id", "text_key", F.struct("start", F.col("k").cast("long").alias("k")).alias("copy"), none.alias("run"))
    runs = maximal_runs(base).select("doc_id", "text_key", none.alias("copy"), F.struct(F.col("line").alias("start"), "k").alias("run"))
    found = copies.unionByName(runs).groupBy("doc_id", "text_key").agg(F.collect_list("copy").alias("copies"), F.collect_list("run").alias("runs"), F.count("run").alias("n_runs"), F.max("run.k").alias("longest_run"))
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_runs", "longest_run")]
    joined = rows.join(found, ["doc_id", "text_key"], "left").select("doc_id", "text", "copies", "row", *counts, "runs")
    kind = rows.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(_delete, f"doc_id long, row {kind}, n_runs long, longest_run long, n_lines long, n_removed long, n_words long, n_removed_words long, text string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later copies of line runs; documents of which no word is left go, documents that had none stay."""
    out = delete_copies(docs, id_col, text_col, min_words).where("n_words = 0 OR n_removed_words < n_words")
    kind = docs.schema[id_col].dataType
    source = {id_col: F.col("doc_id").cast(kind), text_col: F.col("text")}
    return out.select(*(source.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def report(docs: DataFrame, **how) -> DataFrame:
    """One row per document: lines, deleted lines and words, maximal repeated runs, digest of the text that is left (a null text: null)."""
    out = delete_copies(docs, **how)
    return out.select("doc_id", "n_lines", "n_removed", "n_words", "n_removed_words", "n_runs", "longest_run", F.sha2("text", 256).alias("kept_sha256"))
