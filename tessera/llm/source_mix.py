"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree.

1. Every source gets a target of words: weights share ``TOTAL`` times the
   corpus, a target stops at ``MOST`` times its source, the excess is shared
   again by weight until no target is above.
2. A source's blocks (its documents, once for each pass over the source) are
   put in a hashed order; the source's exact quota is the shortest run of
   blocks that holds its target, the last one trimmed.
3. The quotas of all sources are split over equal output shards by a binary
   tree: at every node the left half's share of each source is drawn from the
   multivariate hypergeometric law (each block is equally likely to be in each
   place), so shards have exact sizes and quotas are kept exactly.
4. A shard takes the next blocks of each source's order (disjoint by
   construction) and shuffles them locally.

Everything is DataFrame functions.  Random numbers are hashes of the seed and
of what they decide, so reruns agree.  A hot source is spread: its order is
cut into hash buckets with running totals over buckets, and no window or group
holds more than one bucket, or one shard, of rows.

Cases: null and empty texts have size 0 and are never drawn; a null source is
a source (the last); rows that repeat are blocks of their own; an empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.tables import written

WEIGHTS = (3, 1, 2)
TOTAL, MOST = 1.5, 2.0
SHARD_BLOCKS = 4096
FAN = 64  # sources whose shares are drawn together at a node; more sources are drawn as groups of groups
SEED = 20_240_601


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(*what) -> Column:
    """In (0, 1), decided by ``what``."""
    return (F.xxhash64(F.lit(SEED), *what).bitwiseAND(F.lit((1 << 52) - 1)) + 0.5) / float(1 << 52)


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once."""
    return F.transform(F.array(value), f)[0]


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Inverse-CDF draw: good items among ``drawn`` of ``total``.

    The law's weights follow from each other by their ratio; places beyond
    eight deviations of the mean (less than 1e-14 of the law) are left out.
    """
    n = F.greatest(total, F.lit(1)).cast("double")
    mean = drawn * good / n
    eight = 8 * F.sqrt(F.greatest(mean * (1 - good / n) * (total - drawn) / F.greatest(total - 1, F.lit(1)), F.lit(0.0))) + 8
    low = F.greatest(F.lit(0).cast("long"), drawn + good - total, F.floor(mean - eight))
    high = F.least(drawn, good, F.ceil(mean + eight))

    def next_weight(w: Column, x: Column) -> Column:
        return w * (good - x).cast("double") * (drawn - x) / ((x + 1) * F.greatest(total - good - drawn + x + 1, F.lit(1)).cast("double"))

    def draw(places: Column) -> Column:
        sums = F.aggregate(places, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("z")), lambda a, x: F.struct(next_weight(a["w"], x).alias("w"), (a["z"] + a["w"]).alias("z")))["z"]
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("z"), F.lit(-1).cast("long").alias("at"))
        return _let(sums * u, lambda goal: F.aggregate(places, start, lambda a, x: F.struct(
            next_weight(a["w"], x).alias("w"), (a["z"] + a["w"]).alias("z"),
            F.when((a["at"] < 0) & (a["z"] + a["w"] >= goal), x).otherwise(a["at"]).alias("at")), lambda a: F.when(a["at"] < 0, F.element_at(places, -1)).otherwise(a["at"])))

    return _let(F.sequence(low.cast("long"), high.cast("long")), draw)


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, size and ``copy`` (1, 2, ... for rows that agree in all three)."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[source_col].cast("string").alias("source"), word_count(docs[text_col].cast("string")).alias("size"), F.xxhash64(docs[text_col].cast("string")).alias("text_key"))
    same = W.partitionBy("doc_id", "text_key", "source").orderBy("size")
    return written(rows.withColumn("copy", F.row_number().over(same)), "mix_sizes")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: index by code point (null last), size, weight and target."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    parts = written(sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix_sources")
    before = parts.groupBy("part").count().select("part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    indexed = written(parts.withColumn("place", place).join(F.broadcast(before), "part").select((F.col("before") + F.col("place")).alias("source_no"), "source", "source_size")
                      .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") % len(WEIGHTS)).cast("int") + 1)), "mix_indexed")
    cap = MOST * F.col("source_size")
    total = indexed.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, -1
    while True:  # each round stops at least one more source, or ends; it moves three numbers
        stopped = F.col("weight") * share >= cap if full >= 0 else F.lit(False)
        at = indexed.agg(F.count_if(stopped).alias("n"), F.sum(F.when(stopped, cap)).alias("cap"), F.sum(F.when(~stopped, F.col("weight"))).alias("weight")).first()
        if at["n"] == full or not at["weight"]:
            break
        full, share = at["n"], (TOTAL * total - (at["cap"] or 0)) / at["weight"]
    return indexed.withColumn("target", F.least(F.col("weight") * share, cap))


def ordered_blocks(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Blocks that the mix takes: document, pass, place in the source's order, words taken."""
    rows = sized.where("size > 0").join(targets.select("source_no", F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s")))
    passes = F.explode(F.sequence(F.lit(0), F.lit(math.ceil(MOST) - 1))).alias("pass")
    key = F.xxhash64(F.lit(SEED), "doc_id", "text_key", "copy", "pass")
    buckets = max(1, math.isqrt(sized.count()))
    blocks = (rows.select("doc_id", "text_key", "copy", "size", "source_no", F.floor("target").alias("goal"), passes).withColumn("key", key)
              .withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets))))
    sums = blocks.groupBy("source_no", "pass", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("source_no").orderBy("pass", "bucket").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select("source_no", "pass", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"))
    inside = W.partitionBy("source_no", "pass", "bucket").orderBy("key", "doc_id", "text_key", "copy")
    so_far = F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = (blocks.withColumn("so_far", so_far).withColumn("nth", F.row_number().over(inside) - 1)
              .join(before, ["source_no", "pass", "bucket"])
              .withColumn("left", F.col("goal") - F.col("words_before") - F.col("so_far"))
              .where("left > 0"))
    return placed.select("doc_id", "text_key", "copy", "source_no", "pass", (F.col("n_before") + F.col("nth")).alias("place"), F.least("size", "left").alias("words"))


def _split(level: DataFrame, shards: int, total: int, capacity: DataFrame | None) -> DataFrame:
    """All nodes below the rows (grp, quotas): grp, lo, hi, quotas, offsets.

    ``capacity``: (grp, lo, hi, n) places of the group in each node; without it
    there is one group that owns every place.
    """
    rows = level.select("grp", F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "quotas", F.transform("quotas", lambda _: F.lit(0).cast("long")).alias("offsets"))
    done = [rows]
    for depth in range(max(0, math.ceil(math.log2(max(shards, 1))))):
        inner = rows.where("hi - lo > 1").withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2))
        if capacity is None:
            edge = lambda c: F.floor(F.col(c) * F.lit(total) / F.lit(shards)).cast("long")
            inner = inner.withColumn("left_n", edge("mid") - edge("lo"))
        else:
            left = capacity.select(F.col("grp").alias("g"), F.col("lo").alias("l"), F.col("hi").alias("h"), F.col("n").alias("left_n"))
            inner = inner.join(left, (F.col("grp") == F.col("g")) & (F.col("lo") == F.col("l")) & (F.col("mid") == F.col("h"))).drop("g", "l", "h")
        all_n = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, k: a + k)
        start = F.struct(all_n.alias("total"), F.col("left_n").alias("drawn"), F.array().cast("array<bigint>").alias("out"))

        def step(a: Column, k: Column) -> Column:
            u = _uniform(F.col("grp"), F.col("lo"), F.col("hi"), F.size(a["out"]))
            return _let(hypergeometric(a["total"], k, a["drawn"], u), lambda x: F.struct((a["total"] - k).alias("total"), (a["drawn"] - x).alias("drawn"), F.concat(a["out"], F.array(x)).alias("out")))

        inner = inner.withColumn("left_q", F.aggregate("quotas", start, step, lambda a: a["out"]))
        right_q = F.zip_with("quotas", "left_q", lambda k, x: k - x)
        right_o = F.zip_with("offsets", "left_q", lambda o, x: o + x)
        halves = F.array(F.struct(F.col("lo"), F.col("mid").alias("hi"), F.col("left_q").alias("quotas"), F.col("offsets")),
                         F.struct(F.col("mid").alias("lo"), F.col("hi"), right_q.alias("quotas"), right_o.alias("offsets")))
        rows = inner.select("grp", F.explode(halves).alias("half")).select("grp", "half.*")
        if depth % 4 == 3:
            rows = written(rows.repartition("grp", "lo"), "mix_tree")
        done.append(rows)
    return reduce(DataFrame.unionByName, done)


def shard_quotas(quotas: DataFrame, n_sources: int, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, int]:
    """(source_no, shard, first, n): which places of each source's order go to each shard; and the number of shards."""
    total = quotas.agg(F.sum("n")).first()[0] or 0
    shards = max(1, math.ceil(total / shard_blocks))
    levels = max(1, math.ceil(math.log(max(n_sources, 2), FAN) - 1e-9))
    capacity = nodes = None
    for level in range(1, levels + 1):
        below = FAN ** (levels - level)
        member = quotas.groupBy(F.floor(F.col("source_no") / below).alias("member")).agg(F.sum("n").alias("n"))
        arrays = (member.groupBy(F.floor(F.col("member") / FAN).alias("grp")).agg(F.array_sort(F.collect_list(F.struct("member", "n"))).alias("members"))  # at most FAN members
                  .select("grp", F.col("members.n").alias("quotas")))
        ids = member.groupBy(F.floor(F.col("member") / FAN).alias("g")).agg(F.array_sort(F.collect_list("member")).alias("ids"))
        nodes = (_split(arrays, shards, total, capacity).join(ids, F.col("grp") == F.col("g"))
                 .select("lo", "hi", F.explode(F.arrays_zip("ids", "quotas", "offsets")).alias("m"))
                 .select("lo", "hi", F.col("m.ids").alias("grp"), F.col("m.quotas").alias("n"), F.col("m.offsets").alias("first")))
        if level < levels:
            capacity = nodes = written(nodes, "mix_nodes")
    return nodes.where("hi - lo = 1 AND n > 0").select(F.col("grp").alias("source_no"), F.col("lo").alias("shard"), "first", "n"), shards


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(rows, draws).

    rows: doc_id, text_key, copy, source, size, source_size, target of every document.
    draws: doc_id, text_key, copy, pass, words taken, shard, position in the shard.
    """
    sized = sized_rows(docs, id_col, text_col, source_col)
    targets = written(source_targets(sized), "mix_targets")
    blocks = written(ordered_blocks(sized, targets), "mix_blocks")
    quotas = written(blocks.groupBy("source_no").agg(F.count(F.lit(1)).alias("n")), "mix_quotas")
    shares, _ = shard_quotas(quotas, targets.count(), shard_blocks)
    # one row for each block of the mix: as many as blocks, whatever the size of the quotas they come from
    places = shares.select("source_no", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("place")).hint("merge")
    local = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id", "text_key", "copy", "pass"), "doc_id", "pass")
    draws = (blocks.join(places, ["source_no", "place"]).withColumn("position", F.row_number().over(local) - 1)
             .select("doc_id", "text_key", "copy", "pass", "words", "shard", "position"))
    rows = sized.join(targets.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return rows, draws


def taken_words(docs: DataFrame, **columns) -> DataFrame:
    """One row per document: size, its source's size and target, words the mix takes, first shard and position."""
    rows, draws = mix(docs, **columns)
    per = draws.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("copy").alias("c")).agg(F.sum("words").alias("taken"), F.min(F.struct("shard", "position")).alias("first"))
    mine = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")) & (F.col("copy") == F.col("c"))
    return rows.join(per, mine, "left").select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.col("first.shard").alias("first_shard"), F.col("first.position").alias("first_position"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a document taken twice gives two rows, a trimmed one its first words."""
    rows, draws = mix(docs, id_col, text_col, source_col)
    keyed = docs.select("*", F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col).cast("string")).alias("__text_key"))
    if rows.where("copy > 1").isEmpty():
        keyed = keyed.withColumn("__copy", F.lit(1))
    else:  # rows that agree in id, text and source are numbered; only such tables pay for the sort of the texts
        same = W.partitionBy("__id", "__text_key", source_col).orderBy("__text_key")
        keyed = keyed.withColumn("__copy", F.row_number().over(same))
    drawn = draws.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), F.col("copy").alias("__c"), F.col("words").alias("__words"))
    both = keyed.join(drawn, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__text_key") == F.col("__t")) & (F.col("__copy") == F.col("__c")))
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("__words") < word_count(F.col(text_col)), F.array_join(F.slice(words, 1, F.col("__words").cast("int")), " ")).otherwise(F.col(text_col))
    return both.withColumn(text_col, text).select(*docs.columns)
