"""Small documents that hold the awkward cases, and plain versions of what the operators compute."""
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, `class` long, row string, text_key long, size long, spans string"


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    import random
    r = random.Random(seed)
    out = []
    for i in range(n):
        out.append("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))))
        out.append("\n" if i % 13 == 12 else " ")
    return "".join(out).strip()


def edge_docs(spark):
    long = prose(1, 30_000)
    texts = [(None, "a text without an id"), (1, None), (2, ""), (3, " \n\t "), (4, long), (4, long), (5, "tie tie tie"), (5, "tie tie tie"), (6, prose(2, 80)), (7, prose(2, 80)), (8, "é　ü​ @ 日本"), (-9, prose(3, 60) + "\n\n" + prose(2, 80))]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"s{k % 2}", None, "x", 1, None, 2, 3, "y") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 1, 0), (7, 0, 1), (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")


def sample(spark, path="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{path}/documents.parquet")
