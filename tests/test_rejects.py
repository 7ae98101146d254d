"""Checked reads of text files: what fails stays, with its reason."""
import tempfile

from pyspark.sql import functions as F

from tessera.sources import rejects

SCHEMA = "id bigint, ts timestamp_ntz, amount double"


def _file(spark, lines):
    path = tempfile.mkdtemp(prefix="rejects-") + "/lines"
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    return path


def test_csv_rejects_keep_text_and_first_reason(spark):
    good = "1,2024-01-02 03:04:05,2.5"
    bad = ["2,yesterday,2.5", "3,2024-01-02 03:04:05", "x,2024-01-02 03:04:05,1.0"]
    path = _file(spark, [good, *bad, "4,2024-01-02 03:04:05,-1.0", "5,,7.0"])
    rules = {"no_time": F.col("ts").isNotNull(), "not_positive": F.col("amount") > 0}
    checked = rejects.read_checked(spark, path, SCHEMA, "csv", rules, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    assert [(r.id, r.amount) for r in rejects.clean_rows(checked).collect()] == [(1, 2.5)]
    got = {r.record: r.reason for r in rejects.rejects(checked).collect()}
    assert got == dict.fromkeys(bad, "malformed") | {"4,2024-01-02 03:04:05,-1.0": "not_positive", "5,,7.0": "no_time"}


def test_a_narrow_selection_rejects_the_same_rows(spark):
    path = _file(spark, ["1,2024-01-02 03:04:05,2.5", "2,yesterday,2.5"])
    checked = rejects.read_checked(spark, path, SCHEMA, "csv", timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    assert checked.where("reason IS NULL").select("id").count() == 1 and checked.count() == 2


def test_json_and_no_rows(spark):
    path = _file(spark, ['{"id":1,"amount":1.5}', '{"id":"one"}', '{"id":2', "[]", '{"id":3}'])
    checked = rejects.read_checked(spark, path, "id bigint, amount double", rules={"no_amount": F.col("amount") > 0})
    assert {r.record: r.reason for r in rejects.rejects(checked).collect() if r.reason != "malformed"} == {'{"id":3}': "no_amount"}
    assert {'{"id":"one"}', '{"id":2'} <= {r.record for r in rejects.rejects(checked).collect()}
    assert [r.id for r in rejects.clean_rows(checked).collect()] == [1]
    empty = rejects.read_checked(spark, _file(spark, []), "id bigint")
    assert empty.columns == ["id", "record", "reason"] and empty.count() == 0
