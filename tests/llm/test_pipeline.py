import sys

from fixtures import words

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    import corpus_pipeline as cp
    from test_ngram_join import plain as near_plain
    from test_line_dedup import plain as line_plain

    from tessera.llm import line_dedup
    from tessera.llm import quality_rules as qr
    from tessera.llm.tables import table, written
    docs = table(spark, SF, "documents")
    kept = written(cp.quality(spark, docs, SF), "t")
    want = {r.doc_id for r in qr.judge(docs, table(spark, SF, "labels")).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    lined = written(cp.lines(spark, kept, SF), "t")
    counts = line_plain([(r.doc_id, r.text) for r in kept.collect()], line_dedup.MIN_WORDS)
    gone = {i for i, (n, removed, _) in counts.items() if n == removed}
    assert {r.doc_id for r in lined.collect()} == want - gone
    assert all(r.n_chars == len(r.text) for r in lined.collect())
    single = written(cp.near_duplicates(spark, lined, SF), "t")
    groups = near_plain([(r.doc_id, r.text) for r in lined.collect()])
    assert {r.doc_id for r in single.collect()} == {i for i, (c, _) in groups.items() if c == i}
    mixed = written(cp.mix(spark, single, SF), "t")
    total = sum(len(words(r.text)) for r in single.collect())
    assert abs(sum(len(words(r.text)) for r in mixed.collect()) - 1.5 * total) <= 20
    packed = cp.pack(spark, mixed, SF).collect()
    assert len({p.sequence_id for p in packed}) <= sum(p.length for p in packed) / 1024 * 1.05 + 2
    assert {p.doc_id for p in packed} == {r.doc_id for r in mixed.collect()}


def test_registered_queries():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "corpus_pipeline" in sys.modules
