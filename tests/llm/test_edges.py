"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import edge_docs, labels  # noqa: E402

from tessera.llm import license_scan, line_dedup, ngram_join, packing, permutation_index, pii, quality_classifier, quality_rules, source_mix, substring_dedup  # noqa: E402

PER_DOCUMENT = {
    "pii": lambda d, x: pii.find_personal_data(d),
    "mix": lambda d, x: source_mix.taken_words(d),
    "join": lambda d, x: ngram_join.join(d),
    "licenses": lambda d, x: license_scan.scan_licenses(d),
    "substrings": lambda d, x: substring_dedup.dedup(d),
    "classifier": lambda d, x: quality_classifier.classify(d, x, F.col("source"), F.col("lang")),
    "rules": lambda d, x: quality_rules.judge(d, x),
    "lines": lambda d, x: line_dedup.report(d),
}
FILTERS = {
    "rules": lambda d, x: quality_rules.kept_documents(d, x),
    "lines": lambda d, x: line_dedup.deduplicated(d),
    "join": lambda d, x: ngram_join.one_of_each(d),
    "mix": lambda d, x: source_mix.mixed_documents(d),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_a_row_for_each_document(spark, name):
    docs, known = edge_docs(spark), labels(spark)
    out = PER_DOCUMENT[name](docs, known)
    got = [r["doc_id"] for r in out.collect()]
    want = [r["doc_id"] for r in docs.collect()]
    key = lambda i: (i is None, i or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert PER_DOCUMENT[name](docs.limit(0), known.limit(0)).count() == 0


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(spark, name):
    docs, known = edge_docs(spark), labels(spark)
    out = FILTERS[name](docs, known)
    assert out.columns == docs.columns
    out.collect()
    assert FILTERS[name](docs.limit(0), known.limit(0)).count() == 0


def test_packing_of_edge_documents(spark):
    docs = edge_docs(spark)
    pieces = packing.pack(packing.token_pieces(docs)).collect()
    assert len({(p.doc_id, p.piece) for p in pieces}) >= 11
    assert sum(p.length == 1 for p in pieces) == 2  # null and empty text: the end id alone
    assert packing.pack(packing.token_pieces(docs.limit(0))).count() == 0


def test_vectors_without_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, rep long, v int")
    assert permutation_index.nearest(empty).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (None, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert permutation_index.nearest(nothing).count() == 0


def test_vectors_with_clashing_columns(spark):
    """Columns named as the operator's own change nothing; values against brute force."""
    rows = [(i, [float(i % 7), float(i % 5 - 2), 1.0], i, i * 2, [1.0], [5], 0.5) for i in range(60)]
    clash = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep long, query_id long, v array<double>, ids array<long>, score double")
    got = [tuple(r) for r in permutation_index.nearest(clash).orderBy("query_id", "rank").collect()]
    want = []
    for q in range(0, 60, 20):
        by = sorted((-sum(a * b for a, b in zip(rows[q][1], r[1], strict=True)), r[0]) for r in rows if r[0] != q)[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(by)]
    assert got == want
