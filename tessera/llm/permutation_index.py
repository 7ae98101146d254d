"""Nearest neighbours by inner product: a permutation index with pivot inverted files.

Every vector is represented by the ordered list of its ``PREFIX`` nearest
pivots.  Vectors are dealt to shards; a shard posts them in one inverted file
per pivot, as (vector, place of the pivot in its list).  A query walks the
files of its own pivots; the footrule distance of the two (cut) permutations
is, but for a constant, minus the sum over shared pivots of
``PREFIX - max(place, place)``, so one accumulator per vector ranks the shard.
The best ``RERANK`` of the shard are scored on the original vectors, in double
precision, and the shards' best are merged.

For vectors of different lengths the largest inner product is made an angle by
one more coordinate, ``sqrt(longest**2 - length**2)`` (0 for queries).

Pivots are a sample of at most ``PIVOTS`` vectors, by hash order; every vector
is indexed.  Equal vectors are one entry with its ``k + 1`` smallest ids (no
other can be among the k nearest of any query), so a vector that is repeated
very often costs no more than a rare one.  Queries and shards meet in blocks.

Cases: vectors that are null, zero, or hold null or non-finite components take
no part, neither do null ids or vectors of another size than most (they have no
inner product with the others; of sizes equally common the larger); rows
equal in id and vector count once (the second is no candidate of the first); fewer
candidates than k give them all; an empty table, or one without a usable vector,
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.tables import written

PIVOTS = 256
PREFIX = 32
RERANK = 0.25
MIN_RERANK = 512
SHARD_ROWS = 8192
QUERY_ROWS = 4096
EVERY = 20
NEAREST = 20


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>, dim) of the rows that take part."""
    v = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(fine & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v"))
    most = v.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    return v.where(F.col("dim") == (most["dim"] if most else 0))


def entries(vectors: DataFrame, keep: int) -> DataFrame:
    """One row for each different vector: its smallest id as rep, its ``keep`` smallest ids."""
    by_id = W.partitionBy("v").orderBy("vec_id")
    ranked = vectors.select("v", "vec_id").withColumn("nth", F.dense_rank().over(by_id)).where(F.col("nth") <= keep)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(F.col("ids")[0].alias("rep"), "v", "ids")


def fit_pivots(index: DataFrame, limit: int = PIVOTS) -> tuple[np.ndarray, float]:
    """(pivot matrix with the added coordinate, longest length)."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    longest = float(index.agg(F.max(F.sqrt(square))).first()[0] or 0.0)
    rows = index.orderBy(F.xxhash64("rep"), "rep").limit(limit).select("v").collect()  # at most PIVOTS rows
    return _lifted(np.array([r["v"] for r in rows], np.float64), longest), longest


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    if not len(x):
        return x
    extra = np.sqrt(np.maximum(longest * longest - (x * x).sum(1), 0.0))
    return np.hstack([x, extra[:, None]])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _permutations(lifted: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row, nearest first (ties by pivot number)."""
    m = min(PREFIX, len(pivots))
    return np.argsort(-(lifted @ pivots.T), axis=1, kind="stable")[:, :m].astype(np.int16)


class InvertedFiles:
    """The pivot inverted files of one shard."""

    def __init__(self, permutations: np.ndarray, pivots: int):
        self.rows, self.m = permutations.shape
        flat = permutations.ravel()
        order = np.argsort(flat, kind="stable")
        self.row, self.place = order // self.m, order % self.m
        self.first = np.searchsorted(flat[order], np.arange(pivots + 1))

    def similarity(self, permutation: np.ndarray) -> np.ndarray:
        """Constant minus half the footrule distance to every row."""
        lists = [slice(self.first[p], self.first[p + 1]) for p in permutation]
        rows = np.concatenate([self.row[x] for x in lists])
        gain = np.concatenate([self.m - np.maximum(self.place[x], i) for i, x in enumerate(lists)])
        return np.bincount(rows, gain, minlength=self.rows)


_FOUND = pa.schema([("query", pa.int64()), ("rep", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])


def _searcher(pivots: np.ndarray, longest: float, k: int, rerank: float):
    def search(shard: pa.Table, queries: pa.Table) -> pa.Table:
        if not shard.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        shard = shard.sort_by("rep")
        x, q = _matrix(shard["v"]), _matrix(queries["v"])
        files = InvertedFiles(_permutations(_lifted(x, longest), pivots), len(pivots))
        asked = _permutations(np.hstack([q, np.zeros((len(q), 1))]), pivots)
        some = min(len(x), max(MIN_RERANK, int(np.ceil(rerank * len(x)))))
        query, row, score = [], [], []
        for i in range(len(q)):
            if some < len(x):
                near = files.similarity(asked[i])
                picked = np.argpartition(-near, some - 1)[:some]
            else:
                picked = np.arange(len(x))
            exact = np.einsum("ij,j->i", x[picked], q[i])
            best = np.lexsort((picked, -exact))[:k + 1]  # rows are sorted by rep
            query.append(np.full(len(best), i))
            row.append(picked[best])
            score.append(exact[best])
        row = np.concatenate(row)
        return pa.Table.from_arrays([queries["rep"].take(pa.array(np.concatenate(query))), shard["rep"].take(pa.array(row)), pa.array(np.concatenate(score)), shard["ids"].take(pa.array(row))], schema=_FOUND)
    return search


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST, every: int = EVERY, rerank: float = RERANK) -> DataFrame:
    """The ``k`` nearest rows found for each row whose id is divisible by ``every``."""
    rows = usable(vectors, id_col, vector_col)
    index = written(entries(rows, k + 1), "vectors")
    asked = written(rows.where(F.col("vec_id") % every == 0).select("v", F.col("vec_id").alias("query_id")).distinct().join(index.select("v", "rep"), "v").select("query_id", "rep"), "queries")
    pivots, longest = fit_pivots(index)
    n_shards, n_blocks = max(1, -(-index.count() // SHARD_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    shards = index.select("rep", "v", "ids", deal("rep", n_shards).alias("shard"), every_block)
    queries = written(asked.select("rep").distinct().join(index.select("rep", "v"), "rep"), "query_vectors").select("rep", "v", deal("rep", n_blocks).alias("block"), every_shard)
    found = shards.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(_searcher(pivots, longest, k, rerank), "query long, rep long, score double, ids array<long>")
    best = W.partitionBy("query").orderBy(F.desc("score"), "rep")
    merged = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    each = merged.select("query", "score", F.explode("ids").alias("vec_id")).withColumn("nth", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= k + 1)
    answers = asked.join(each, asked["rep"] == each["query"]).where("vec_id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id", "query").orderBy("nth"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
