"""License scans: exact set-similarity join of text blocks with license templates.

Blocks are runs of ``BLOCK`` words, one every ``STRIDE`` words, so every run of
up to ``STRIDE`` words lies whole inside a block.  A block matches a template
if it holds at least ``CONTAINMENT`` of the template's distinct words.  The
join is exact: template words are ordered by their frequency over all
documents, rarest first; a matching block must hold one of the first
``|T| - needed + 1`` words of the template (prefix filter), must hold
``needed`` template words at all (length filter), and the places of a shared
prefix word in both orders bound the overlap (positional filter); what is left
is verified on the full sets.  Fixed phrases are counted beside that, at word
places.

Everything is DataFrame functions.  The templates and their words (a fixed,
small list) are literals; of the corpus only blocks that hold a prefix word go
beyond the scan.

Cases: a null text is an empty one (no words, no labels, score 0); repeated
rows give repeated rows; rows that share an id but not a text are kept apart.
"""
from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTAINMENT = 0.85
BLOCK, STRIDE = 64, 32

# FIXED VALUES: phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# FIXED VALUES: key sentences of public license notices.
TEMPLATES = [
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("creative-commons", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of other ASCII than letters and digits separate."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, _BETWEEN_WORDS), lambda w: w != "")


def _spaces(x: Column) -> Column:
    return (F.length(x) - F.length(F.translate(x, " ", ""))).cast("long")


def _phrase_places(joined: Column, n_words: Column, phrase: str) -> Column:
    """struct(n, first, last): places of a phrase in ``" w0 w1 ... "`` as word numbers."""
    parts = F.split(joined, f" {phrase}(?= )")
    n = (F.size(parts) - 1).cast("long")
    last = n_words - (_spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())
    found = F.struct(n.alias("n"), _spaces(F.element_at(parts, 1)).alias("first"), last.alias("last"))
    none = F.lit(None).cast("struct<n:bigint,first:bigint,last:bigint>")
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), found).otherwise(none)


def phrase_scan(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): key, n_words and the fixed phrases' count, first and last place, labels."""
    d = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    d = d.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("joined"))
    d = d.select("doc_id", "text_key", "n_words", *(_phrase_places(F.col("joined"), F.col("n_words"), p).alias(f"p{i}") for i, p in enumerate(PHRASES)))
    places = [F.col(f"p{i}") for i in range(len(PHRASES))]
    labels = F.array_compact(F.array(*(F.when(p.isNotNull(), F.lit(label)) for p, label in zip(places, PHRASES.values(), strict=True))))
    return d.select("doc_id", "text_key", "n_words", sum((F.coalesce(p["n"], F.lit(0)) for p in places), F.lit(0)).cast("long").alias("n_base"), F.least(*(p["first"] for p in places)).alias("first_word"), F.greatest(*(p["last"] for p in places)).alias("last_word"), F.array_sort(F.array_distinct(labels)).alias("base"))


def frequency_order(docs: DataFrame) -> dict[str, int]:
    """Rank of every template word by its frequency over all documents, rarest first (ties by the word)."""
    vocabulary = sorted({w for _, t in TEMPLATES for w in t.split()})
    found = docs.select(F.explode(words_of(F.col("text"))).alias("w")).where(F.col("w").isin(vocabulary)).groupBy("w").count()
    count = {r["w"]: r["count"] for r in found.collect()}  # at most one row for each template word
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}


def template_matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, labels, score) of the rows with a block that contains a template."""
    rank = frequency_order(docs)
    sets = [sorted({rank[w] for w in t.split()}) for _, t in TEMPLATES]
    needed = [math.ceil(CONTAINMENT * len(s)) for s in sets]
    prefix = {(s[p], i, p) for i, s in enumerate(sets) for p in range(len(s) - needed[i] + 1)}
    by_rank = {r: w for w, r in rank.items()}
    ranks = F.create_map(*(x for w, r in rank.items() for x in (F.lit(w), F.lit(r))))
    rare = F.array(*(F.lit(by_rank[r]) for r in sorted({r for r, _, _ in prefix})))

    d = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size("words") - 1) / STRIDE), F.lit(0)).cast("int"))
    block = F.transform(starts, lambda k: F.slice(F.col("words"), k * STRIDE + 1, BLOCK))
    held = F.sort_array(F.array_compact(F.transform(F.array_distinct("block"), lambda w: F.try_element_at(ranks, w))))
    near = (d.select("doc_id", "text_key", F.posexplode(block).alias("k", "block")).where(F.arrays_overlap("block", rare))
            .select("doc_id", "text_key", "k", held.alias("held")))

    spark = docs.sparkSession
    posted = spark.createDataFrame([(r, i, p, len(sets[i]), needed[i]) for r, i, p in sorted(prefix)], "rank int, template int, p int, t_size int, needed int")
    whole = spark.createDataFrame([(i, s, TEMPLATES[i][0]) for i, s in enumerate(sets)], "template int, t_ranks array<int>, label string")
    b_size = F.size("held")
    bound = F.least("p", "q") + 1 + F.least(F.col("t_size") - F.col("p") - 1, b_size - F.col("q") - 1)
    pairs = (near.select("doc_id", "text_key", "k", "held", F.posexplode("held").alias("q", "rank")).join(F.broadcast(posted), "rank")
             .where((b_size >= F.col("needed")) & (bound >= F.col("needed")))
             .join(F.broadcast(whole), "template"))
    overlap = F.size(F.array_intersect("held", "t_ranks"))
    hits = pairs.where(overlap >= F.col("needed")).select("doc_id", "text_key", "label", (overlap / F.size("t_ranks")).alias("score"))
    return hits.groupBy("doc_id", "text_key").agg(F.collect_set("label").alias("found"), F.max("score").alias("found_score"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, places of the fixed phrases, labels with and without the template join, score."""
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    base = phrase_scan(texts)
    found = template_matches(texts).withColumnsRenamed({"doc_id": "f_id", "text_key": "f_key"})
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left")
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_union("base", F.coalesce("found", none)))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.round(F.coalesce("found_score", F.lit(0.0)), 6))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))
