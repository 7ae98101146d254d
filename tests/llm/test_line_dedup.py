import hashlib

import pytest
from fixtures import sample

from tessera.llm import line_dedup as ld


def runs(n, least):
    out = set()
    for x in range(len(n)):
        for step in (1, -1):
            y, c = x, 0
            while 0 <= y < len(n):
                c += n[y]
                if c >= least:
                    out.add((min(x, y), max(x, y) + 1))
                    break
                y += step
    return out


def plain(rows, least):
    docs, seen, out = [], {}, {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if x.split()]
        seq = [tuple(lines[k].split()) for k in at]
        docs.append((i, lines, at, seq))
        for x, y in sorted(runs([len(s) for s in seq], least)):
            seen.setdefault(tuple(seq[x:y]), (i, x))
    for i, lines, at, seq in docs:
        gone = {at[k] for x, y in runs([len(s) for s in seq], least) if seen[tuple(seq[x:y])] < (i, x) for k in range(x, y)}
        out[i] = (len(at), len(gone), hashlib.sha256("\n".join(x for k, x in enumerate(lines) if k not in gone).encode()).hexdigest())
    return out


def plain_runs(rows):
    """(number of maximal runs, lines of the longest) per document, by comparing every line with every other."""
    seqs = {i: [tuple(x.split()) for x in t.split("\n") if x.split()] for i, t in set(rows)}
    places = {}
    for i, seq in seqs.items():
        for x, line in enumerate(seq):
            places.setdefault(line, []).append((i, x))
    out = {}
    for i, seq in seqs.items():
        best = []
        for x in range(len(seq)):
            longest = 0
            for j, y in places[seq[x]]:
                k = 0
                while (i, x) != (j, y) and x + k < len(seq) and y + k < len(seqs[j]) and seq[x + k] == seqs[j][y + k]:
                    k += 1
                longest = max(longest, k)
            best.append(longest)
        out[i] = (sum(k > 0 and (x == 0 or best[x - 1] <= k) for x, k in enumerate(best)), max(best, default=0))
    return out


def test_maximal_runs_equal_brute_force(spark):
    import random
    rng = random.Random(5)
    rows = [(k, "\n".join(rng.choice("abcd") for _ in range(rng.randrange(12)))) for k in range(40)]
    block = [f"line {k} of a passage" for k in range(21)]
    rows += [(100, "\n".join(block)), (101, "own\n" + "\n".join(block[3:]) + "\nend"), (102, "\n".join(block[:19] + ["q"])),
             (103, "\n".join(["again"] * 33)), (104, "\n".join(block * 2)), (105, ""), (106, "nothing like it"), (106, "nothing like it")]
    got = {r.doc_id: (r.n_runs, r.longest_run) for r in ld.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_runs(rows) and got[104][1] == 21 and got[103] == (2, 32)


def test_maximal_runs_of_the_sample(spark):
    docs = sample(spark).select("doc_id", "text")
    got = {r.doc_id: (r.n_runs, r.longest_run) for r in ld.report(docs).collect()}
    assert got == plain_runs([(r.doc_id, r.text or "") for r in docs.collect()])
    assert max(k for _, k in got.values()) > 1


def test_runs_of_rows_without_id_and_of_no_rows(spark):
    rows = [(None, "a b\nc d"), (None, "a b\nc d"), (None, "x\na b\nc d"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.n_lines, r.n_runs, r.longest_run) for r in ld.report(docs).collect()) == [(0, 0, 0), (2, 1, 2), (2, 1, 2), (3, 1, 2)]
    assert ld.report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("least", [1, 5, 16])
def test_equals_brute_force(spark, least):
    a, b, c, d = "one two three", "four five", "six seven eight nine ten eleven", "x"
    more = [(1000, f"{a}\n{b}\n{c}"), (1001, f"{d}\n{a}\n{b}\n{c}\n{d}"), (1002, f"{b}\n{c}\n\n{a}\n{b}"), (1003, f"{a} \n\n{b}\n{c}"), (1004, f"{c}\n{c}\n{c}\n{c}"), (1005, f"{c}\n{c}\n{c}"), (1006, "\n")]
    docs = sample(spark).select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in ld.report(docs, min_words=least).collect()}
    want = plain([(r.doc_id, r.text) for r in docs.collect()], least)
    assert got == want and sum(x[1] for x in want.values()) > 10


def test_deduplicated_documents(spark):
    run = "\n".join(f"line {k} with a few words in it" for k in range(4))
    docs = spark.createDataFrame([(1, "a", run), (2, "b", f"own\n{run}\nend"), (3, "c", run), (4, "d", ""), (5, "e", None)], "doc_id long, row string, text string")
    got = {r.doc_id: (r.row, r.text) for r in ld.deduplicated(docs).collect()}
    assert got == {1: ("a", run), 2: ("b", "own\nend"), 4: ("d", ""), 5: ("e", None)}


def test_short_repeated_lines_go(spark):
    docs = spark.createDataFrame([(k, f"own text number {k}\nRead more\nand its end {k}\nHome") for k in range(5)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in ld.deduplicated(docs).collect()}
    assert got == {k: f"own text number {k}\nRead more\nand its end {k}\nHome" if k == 0 else f"own text number {k}\nand its end {k}" for k in range(5)}


def test_the_query_leaves_no_repeated_line(spark):
    docs = sample(spark).select("doc_id", "text")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in ld.report(docs).collect()}
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()], 1)
    left = [tuple(x.split()) for r in ld.deduplicated(docs).collect() for x in (r.text or "").split("\n") if x.split()]
    assert len(left) == len(set(left))


def test_runs_do_not_depend_on_ranges(spark, monkeypatch):
    docs = sample(spark).select("doc_id", "text")
    want = ld.report(docs).collect()
    monkeypatch.setattr(ld, "RANGE_ROWS", 40)
    assert sorted(ld.report(docs.repartition(3)).collect()) == sorted(want)


def test_deletions_come_from_the_maximal_runs_of_the_array(spark, monkeypatch):
    rows = [(1, "a b\nc d\ne"), (2, "x\na b\nc d"), (3, "c d\ny\nx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    built, runs = [], ld.maximal_runs
    monkeypatch.setattr(ld, "maximal_runs", lambda base: built.append(runs(base)) or built[-1])
    assert {r.doc_id: r.text for r in ld.deduplicated(docs).collect()} == {1: "a b\nc d\ne", 2: "x", 3: "y"}
    assert {(r.doc_id, r.line, r.k) for r in built[0].collect()} == {(1, 0, 2), (2, 0, 1), (2, 1, 2), (3, 0, 1), (3, 2, 1)}
    monkeypatch.setattr(ld, "maximal_runs", lambda base: runs(base).where("doc_id <> 2"))  # what no maximal run holds stays
    assert {r.doc_id: r.text for r in ld.deduplicated(docs).collect()} == {1: "a b\nc d\ne", 2: "x\na b\nc d", 3: "y"}
