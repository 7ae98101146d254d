import math

from fixtures import sample
from pyspark.sql import functions as F

from tessera.llm import license_scan as ls

import re

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    places = [(k, label) for phrase, label in ls.PHRASES.items() for p in [phrase.split()] for k in range(len(w)) if w[k:k + len(p)] == p]
    found = {label for _, label in places}
    score = 1.0 if places else 0.0
    more = set()
    for k in range(max(0, (len(w) - 1) // ls.STRIDE) + 1):
        block = set(w[k * ls.STRIDE:k * ls.STRIDE + ls.BLOCK])
        for label, t in ls.TEMPLATES:
            t = set(t.split())
            if len(block & t) >= math.ceil(ls.CONTAINMENT * len(t)):
                more.add(label)
                score = max(score, round(len(block & t) / len(t), 6))
    at = [k for k, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(found)), ",".join(sorted(found | more)), score)


def test_equals_brute_force(spark):
    filler = " ".join(f"pad{k}" for k in range(45))
    notice = ls.TEMPLATES[6][1]
    more = [f"{filler} {t} {filler}" for _, t in ls.TEMPLATES]
    more += [f"{filler} " * 9 + " ".join(w for i, w in enumerate(notice.split()) if i != 4), "Under the MIT license, under the MIT License", "UNDER-THE\nMIT_LICENSE", "cc by nc cc by nc", "", None, "Apache License, Version 2.0", "gnu gnu gnu mit the the", "é under the mit licenseé", notice + " " + notice]
    docs = sample(spark, "/root/testdata/sf0.01").select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = {r.doc_id: tuple(r)[1:] for r in ls.scan_licenses(docs).collect()}
    want = {r.doc_id: plain(r.text) for r in docs.collect()}
    assert got == want


def test_no_python_in_the_plan(spark):
    plan = ls.scan_licenses(sample(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_prefix_words_are_rare(spark):
    docs = spark.createDataFrame([(1, "the the the of"), (2, "the gnu")], "doc_id long, text string")
    rank = ls.frequency_order(docs.select(F.col("text")))
    assert rank["gnu"] > rank["apache"] and rank["the"] == max(rank.values())
