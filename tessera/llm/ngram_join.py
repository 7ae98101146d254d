"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

1. A document's n-grams are its runs of ``NGRAM`` words (a shorter document has
   one, all its words).  Documents with the same word sequence are one class;
   classes are joined, copies only counted.
2. Bands and rows are chosen for the target recall at the threshold
   (``choose_bands``).  Band hashes are shuffled; a bucket of two or more
   classes makes them candidates of each other through the bucket's smallest
   class, its centre.  A class keeps one edge, to its least centre, and its other
   centres are linked to that one: about an edge a class, not one a band.
3. Candidates that hang together form a cluster.  Clusters are cut into blocks of
   bounded numbers and bytes, and every pair of blocks of a cluster is verified in one task: exact
   intersection sizes of the full n-gram sets, by a matrix product for common
   n-grams and by short posting lists for the others.  Tasks give link counts
   and a forest over the links found, never the pairs.
4. Groups are the components of all links.

Every link between candidates of a cluster is found; a pair at the threshold
becomes a candidate with the target recall (more above it).

Cases: a document without words is a group of its own; a null doc_id is a
document (it never names a group that has an id); repeated rows are copies of
each other; an empty table gives an empty result; other columns are ignored.
N-grams are compared by 64-bit hashes.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.graph import components
from tessera.llm.tables import written
from tessera.llm.textops import RangeHash, Slice, _WORD_MULT, mix64, slices, text_slices

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 320
BLOCK = 1024          # classes in a block of a cluster
BLOCK_BYTES = 16 << 20  # of n-gram sets in a block, on average
COMMON = 48           # n-grams in more sets than this are counted by a matrix product
NULL_ID = -(1 << 63)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): as many rows a band as ``max_hashes`` allows with ``recall`` at the threshold."""
    best = None
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches that recall with so few hashes")
    return best


def _ngrams(s: Slice, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every n-gram, by document."""
    at, h = s.windows(words, n)
    doc = s.word_doc[at]
    short = np.flatnonzero((s.n_words > 0) & (s.n_words < n))
    if len(short):
        whole = RangeHash(words, _WORD_MULT)(s.first[short], s.first[short + 1])
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
        order = np.argsort(doc, kind="stable")
        doc, h = doc[order], h[order]
    return doc, h


def _signer(bands: int, rows: int, n: int):
    rng = np.random.default_rng(20_240_602)
    mult = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
    flip = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def sign(batches):
        for s in text_slices(batches):
            s.split_words()
            words = s.word_hashes()
            doc, h = _ngrams(s, words, n)
            has = np.flatnonzero(s.n_words)
            sequence = np.zeros(s.n_docs, np.uint64)
            band = np.zeros((len(has), bands), np.uint64)
            if len(has):
                sequence[has] = RangeHash(words, _WORD_MULT)(s.first[has], s.first[has + 1])
                first = np.searchsorted(doc, has)
                x = (h >> np.uint64(32)).astype(np.uint32)
                for i in range(bands * rows):
                    low = np.minimum.reduceat((x ^ flip[i]) * mult[i], first).astype(np.uint64)
                    b = i // rows
                    band[:, b] = mix64(band[:, b] * np.uint64(0x9E3779B97F4A7C15) + low + np.uint64(b + 1))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum((s.n_words > 0) * bands)]).astype(np.int32)), pa.array(band.ravel().view(np.int64)))
            klass = pa.array(sequence.view(np.int64), mask=s.n_words == 0)
            yield pa.RecordBatch.from_arrays([s.ids, pa.array(s.n_words.astype(np.int64)), klass, lists], names=["doc_id", "n_words", "class", "bands"])
    return sign


def _sets(n: int):
    def sets(batches):
        """Rows (doc_id, text, wanted class) -> (class, size, sorted n-gram hashes) of those whose words are the class's."""
        for batch in batches:
            at = 0
            for s in slices(batch.column(0), batch.column(1)):
                s.split_words()
                words = s.word_hashes()
                doc, h = _ngrams(s, words, n)
                bound = np.searchsorted(doc, np.arange(s.n_docs + 1))
                want = batch.column(2).slice(at, s.n_docs).to_numpy()
                at += s.n_docs
                have = RangeHash(words, _WORD_MULT)(s.first[:-1], s.first[1:]).view(np.int64)
                out = [(want[d], np.unique(h[bound[d]:bound[d + 1]])) for d in np.flatnonzero((want == have) & (s.n_words > 0))]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([x.nbytes for _, x in out], pa.int64()), pa.array([x.tobytes() for _, x in out], pa.binary())], names=["class", "bytes", "grams"])
    return sets


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of exact intersection sizes."""
    k = len(sets)
    sizes = np.array([len(x) for x in sets])
    value, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(k), sizes)
    held = count[column] > 1
    row, column = row[held], column[held]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((k, k), np.float32)
    df = count[column]
    common = df > COMMON
    _, c = np.unique(column[common], return_inverse=True)
    r = row[common]
    for lo in range(0, int(c.max()) + 1 if len(c) else 0, 4096):
        mine = (c >= lo) & (c < lo + 4096)
        m = np.zeros((k, min(4096, int(c.max()) + 1 - lo)), np.float32)
        m[r[mine], c[mine] - lo] = 1
        out += m @ m.T
    cells = []
    for d in np.unique(df[~common]):
        members = row[(df == d)].reshape(-1, d)  # rows of one n-gram stand together, in order
        for p in range(d):
            for q in range(p + 1, d):
                cells.append(members[:, p] * k + members[:, q])
    if cells:
        upper = np.bincount(np.concatenate(cells), minlength=k * k).reshape(k, k).astype(np.float32)
        out += upper + upper.T
    np.fill_diagonal(out, sizes)
    return out


def _verify(threshold: float):
    def verify(group: pd.DataFrame) -> pd.DataFrame:
        """All blocks pairs of a task: per class the texts and documents linked, and an edge to the first of its linked classes."""
        parts = []
        for (_, i, j), pair in group.groupby(["cluster", "i", "j"], sort=True):
            pair = pair.sort_values("class", kind="stable")
            sets = [np.frombuffer(x, np.uint64) for x in pair["grams"]]
            both = intersections(sets)
            size = both.diagonal()
            # 1e-9: a ratio that is exactly the threshold stays linked in floating point
            linked = both >= (threshold - 1e-9) * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            block = pair["block"].to_numpy()
            if i != j:
                linked &= block[:, None] != block[None, :]
            klass = pair["class"].to_numpy()
            has = np.flatnonzero(linked.any(axis=1))
            root = _roots(linked, has)
            parts.append(pd.DataFrame({"class": klass[has], "n_texts": linked[has].sum(axis=1).astype(np.int64), "n_docs": (linked[has] @ pair["copies"].to_numpy().astype(np.float64)).astype(np.int64), "root": klass[root[has]]}))
        return pd.concat(parts) if parts else pd.DataFrame({"class": [], "n_texts": [], "n_docs": [], "root": []}).astype(np.int64)
    return verify


def _roots(linked: np.ndarray, has: np.ndarray) -> np.ndarray:
    """The first node of each node's component."""
    root = np.full(len(linked), -1)
    for start in has:
        if root[start] >= 0:
            continue
        front = np.zeros(len(linked), bool)
        front[start] = True
        while front.any():
            root[front] = start
            front = linked[front].any(axis=0) & (root < 0)
    return root


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, text_key, class (null without words), grp, class_doc, group_doc, n_texts, n_links."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), F.xxhash64(docs[text_col].cast("string")).alias("text_key"))
    bands, rows = choose_bands(threshold, recall)
    signed = written(_with_key(texts, _signer(bands, rows, n)), "signatures")
    classes = written(signed.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("class_doc"), F.min(F.struct("doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "classes")
    band = classes.select("class", F.explode("bands").alias("bucket"))
    buckets = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("center")).where("n > 1").select("bucket", "center")
    clusters = written(components(_candidate_edges(band.join(buckets, "bucket"))).withColumnRenamed("node", "class"), "clusters")
    found = written(_links(texts, classes, clusters, n, threshold), "links")
    per_class = found.groupBy("class").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    linked = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = classes.select("class", "class_doc", "copies").join(linked.withColumnRenamed("node", "class"), "class", "left").withColumn("grp", F.coalesce("component", "class"))
    smallest = named.groupBy("grp").agg(F.min("class_doc").alias("group_doc"))
    of_class = named.join(smallest, "grp").join(per_class, "class", "left").select("class", "grp", "class_doc", "group_doc", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), (F.coalesce("n_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("doc_id", "text_key", "class").join(of_class, "class", "left")


def _with_key(texts: DataFrame, sign) -> DataFrame:
    """Signatures with the key of the text behind them."""
    def keyed(batches):
        for batch in batches:
            at = 0
            for out in sign([batch.select([0, 1])]):
                yield pa.RecordBatch.from_arrays([*out.columns, batch.column(2).slice(at, out.num_rows)], names=[*out.schema.names, "text_key"])
                at += out.num_rows
    return texts.mapInArrow(keyed, "doc_id long, n_words long, class long, bands array<long>, text_key long")


def _candidate_edges(member: DataFrame) -> DataFrame:
    """Edges (a, b) that hang the classes of every bucket together; ``member``: class, center, a row for each bucket of a class (at most one a band)."""
    least = member.groupBy("class").agg(F.min("center").alias("b"), F.collect_set("center").alias("centers"))
    return least.select("b", F.explode(F.array_union("centers", F.array("class"))).alias("a")).where("a <> b").select("a", "b").distinct()


def _links(texts: DataFrame, classes: DataFrame, clusters: DataFrame, n: int, threshold: float) -> DataFrame:
    """(class, n_texts, n_docs, root) of every block pair's links."""
    # one document of each class, by id and text (ids may be null or repeated)
    of_doc = clusters.join(classes, "class").select(F.coalesce("first.doc_id", F.lit(NULL_ID)).alias("d"), F.col("first.text_key").alias("text_key"), "class")
    keyed = texts.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("d"), "text_key", "text")
    sets = written(keyed.join(of_doc, ["d", "text_key"]).select("d", "text", "class").mapInArrow(_sets(n), "class long, bytes long, grams binary"), "ngram_sets")
    weighed = clusters.join(sets.groupBy("class").agg(F.max("bytes").alias("bytes")), "class").groupBy("component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    size = written(weighed.select("component", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"), "n", "bytes"), "cluster_sizes")
    total = size.where("blocks = 1").agg(F.sum("n"), F.sum("bytes")).first()
    tasks = max(1, -(-(total[0] or 0) // (2 * BLOCK)), -(-(total[1] or 0) // (2 * BLOCK_BYTES)))
    size, sets = size.select("component", "blocks"), sets.select("class", "grams").dropDuplicates(["class"])
    member = clusters.join(size, "component").select("class", F.col("component").alias("cluster"), "blocks", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"))
    member = member.join(sets, "class").join(classes.select("class", "copies"), "class")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = member.select("*", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(F.xxhash64("cluster", "i", "j"))
    return paired.withColumn("task", task).groupBy("task").applyInPandas(_verify(threshold), "class long, n_texts long, n_docs long, root long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: class_id (smallest doc_id of its group), copy_of (of its equal texts), links to other documents and texts."""
    g = groups(docs, id_col, text_col, **how)
    return g.select("doc_id", F.coalesce("group_doc", "doc_id").alias("class_id"), F.coalesce("class_doc", "doc_id").alias("copy_of"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_text_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest doc_id (ties by the text's key); documents without words stay."""
    g = written(groups(docs, id_col, text_col, **how).select("doc_id", "text_key", "class", "grp"), "groups")
    first = F.row_number().over(W.partitionBy("grp").orderBy(F.col("doc_id").asc_nulls_last(), "text_key"))
    stay = written(g.where("class IS NOT NULL").withColumn("nth", first).where("nth = 1").select("doc_id", "text_key"), "stay").withColumnsRenamed({"doc_id": "__d", "text_key": "__t"})
    wordless = g.where("class IS NULL").select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t")).distinct()
    keyed = docs.withColumn("__id", F.col(id_col).cast("long")).withColumn("__key", F.xxhash64(F.col(text_col).cast("string")))
    mine = F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__t"))
    flagged = keyed.join(stay.withColumn("__once", F.lit(True)).unionByName(wordless.withColumn("__once", F.lit(False))), mine)
    rows_again = g.where("class IS NOT NULL").join(stay, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_key") == F.col("__t"))).groupBy("__d", "__t").count().where("count > 1")
    if rows_again.isEmpty():
        return flagged.select(*docs.columns)
    again = flagged.where("__once").dropDuplicates(["__id", "__key"]).unionByName(flagged.where("NOT __once"))
    return again.select(*docs.columns)
