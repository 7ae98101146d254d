"""Physical table readers and the bindings of the logical tables to them.

Every reader declares its columns, so a projection prunes at the parquet scan
and a wrong file fails fast. The ``*_from_*`` bindings only rename / derive
columns into the logical schema the operators expect; they do none of the
operators' work.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]

SCHEMAS: dict[str, T.StructType] = {
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType())]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType())]),
}


def read_table(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Read one table with its declared schema (parquet / csv / json / orc)."""
    path = os.path.join(sf_dir, f"{name}.{fmt}") if not name.endswith(f".{fmt}") else name
    reader = spark.read
    schema = SCHEMAS.get(name)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def validate(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail fast when a column of ``schema`` is missing or has another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"missing column {f.name}")
        if have[f.name] != f.dataType:
            raise ValueError(f"column {f.name}: {have[f.name]} is not {f.dataType}")
    return df


class Tables:
    """Lazy per-directory table access: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


# ---------------------------------------------------------------------------
# Logical schemas (what the operators consume)
# ---------------------------------------------------------------------------
TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("product_category", T.StringType()), T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_date", T.TimestampNTZType())])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("registration_date", T.TimestampNTZType())])

PREDICTION_LOG = T.StructType([
    T.StructField("prediction_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("model_name", T.StringType()), T.StructField("prediction", T.IntegerType()),
    T.StructField("confidence", T.DoubleType()), T.StructField("processing_time", T.DoubleType())])


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> transactions (one row per order)."""
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("product_category"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("transaction_date"))


def transaction_lines_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem -> transaction lines keyed by (l_orderkey, l_linenumber)."""
    return lineitem


def customers_from_tables(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """customer + nation + orders -> customers.

    ``gender`` is bound to the market segment code, ``city`` to the nation
    name, ``registration_date`` to the first order date, and ``age`` (absent
    in the test tables) to ``18 + c_custkey % 70``.
    """
    first_order = (orders.groupBy(F.col("o_custkey").alias("customer_id"))
                   .agg(F.min("o_orderdate").alias("registration_date")))
    base = (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    (F.lit(18) + F.pmod(F.col("c_custkey"), F.lit(70))).cast("int").alias("age"),
                    F.col("c_mktsegment").alias("gender"), F.col("n_name").alias("city")))
    return base.join(first_order, "customer_id", "left")


def prediction_log_from_events(events: DataFrame) -> DataFrame:
    """events -> prediction log: one scored row per event.

    model = event_type; prediction = value > 50; confidence =
    0.5 + 0.5 * least(value, 100) / 100; processing time = value (ms).
    """
    v = F.col("value")
    return events.select(
        F.col("event_id").alias("prediction_id"), "ts",
        F.col("event_type").alias("model_name"),
        (v > 50).cast("int").alias("prediction"),
        (F.lit(0.5) + F.lit(0.5) * F.least(v, F.lit(100.0)) / F.lit(100.0)).alias("confidence"),
        v.alias("processing_time"))


# Scorers over documents: (name, score column builder). Prediction = score >= 0.5.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = _UPPER + _UPPER.lower()


def _count_chars(text: str, chars: str) -> F.Column:
    """Occurrences of any of ``chars`` in the whole text (character-map delete, no regex)."""
    return F.length(F.col(text)) - F.length(F.translate(F.col(text), chars, ""))


def _alpha_share(text: str = "text") -> F.Column:
    return _count_chars(text, _LETTERS) / F.greatest(F.length(F.col(text)), F.lit(1))


def _upper_free_share(text: str = "text") -> F.Column:
    return F.lit(1.0) - _count_chars(text, _UPPER) / F.greatest(F.length(F.col(text)), F.lit(1))


DOCUMENT_SCORERS = {
    "length": lambda: F.col("n_chars") / (F.col("n_chars") + F.lit(1000.0)),
    "alpha_share": _alpha_share,
    "upper_free_share": _upper_free_share,
}


def scored_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents ⋈ labels scored by each scorer: (model_name, doc_id, label, score, prediction)."""
    joined = documents.join(labels, "doc_id")
    cols = [F.struct(F.lit(name).alias("model_name"), fn().cast("double").alias("score"))
            for name, fn in DOCUMENT_SCORERS.items()]
    out = (joined.select("doc_id", F.col("quality").alias("label"),
                         F.explode(F.array(*cols)).alias("s"))
           .select(F.col("s.model_name").alias("model_name"), "doc_id", "label",
                   F.col("s.score").alias("score")))
    return out.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def run_log_from_events(events: DataFrame) -> DataFrame:
    """events -> run log: step = event_type, status = error -> 'error' else 'success'."""
    return events.select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("step"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("props").alias("message"))


# Pipeline steps that the event types stand for where every step family should occur.
STEP_OF_EVENT = {"click": "data_collection_customers", "signup": "feature_engineering_rfm",
                 "view": "model_training", "purchase": "batch_predictions", "error": "roi_analysis"}


def step_log_from_events(events: DataFrame) -> DataFrame:
    """events -> run log with named pipeline steps; steps of a value below 10 failed."""
    step = F.coalesce(*[F.when(F.col("event_type") == e, F.lit(s)) for e, s in STEP_OF_EVENT.items()], F.lit("setup"))
    return events.select(F.col("ts").alias("timestamp"), step.alias("step"),
                         F.when(F.col("value") < 10, "error").otherwise("success").alias("status"),
                         F.col("props").alias("message"))


def shifting_log_from_events(events: DataFrame) -> DataFrame:
    """events -> prediction log whose positive rate and confidence fall over the month, so that drift fires:
    prediction = value > 4 * day of month; confidence = 1 - day of month / 60, NULL for every seventh event."""
    day = F.dayofmonth("ts")
    return events.select(
        F.col("event_id").alias("prediction_id"), "ts", F.col("event_type").alias("model_name"),
        (F.col("value") > day * F.lit(4.0)).cast("int").alias("prediction"),
        F.when(F.col("event_id") % 7 != 0, F.lit(1.0) - day / F.lit(60.0)).alias("confidence"),
        F.col("value").alias("processing_time"))


def bursting_log_from_events(events: DataFrame, day: str, copies: int = 3) -> DataFrame:
    """The log of :func:`shifting_log_from_events` with every row of one day ``copies`` times, so that volume jumps on it."""
    log = shifting_log_from_events(events)
    times = F.when(F.to_date("ts") == F.lit(day).cast("date"), F.lit(copies)).otherwise(F.lit(1))
    return log.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def browsing_events(events: DataFrame, before: str | None = None) -> DataFrame:
    """Views and errors (before a time): customers with few interests who never buy."""
    kept = events.where(F.col("event_type").isin("view", "error"))
    return kept if before is None else kept.where(F.col("ts") < F.lit(before).cast("timestamp_ntz"))


def text_times_from_events(events: DataFrame) -> DataFrame:
    """events -> (event_id, transaction_date as text); error events hold a text that is no time."""
    return events.select("event_id", F.when(F.col("event_type") == "error", F.lit("not a time"))
                         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("transaction_date"))


def records_from_events(events: DataFrame) -> DataFrame:
    """events -> JSON lines of id, time and whole value; error events hold a text that is no time, every seventh id loses its last character."""
    time = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    line = F.to_json(F.struct("event_id", time.alias("ts"), F.floor("value").alias("value")))
    return events.select(F.when(F.col("event_id") % 7 == 0, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value"))


def account_holders(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer + nation -> customers whose ages run from 0 to 119; the city is "<nation>'s o'er-<segment>" in lower case."""
    return (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.pmod(F.col("c_custkey"), F.lit(120)).cast("int").alias("age"),
                    F.lower(F.concat(F.col("n_name"), F.lit("'s o'er-"), F.col("c_mktsegment"))).alias("city"),
                    F.col("c_acctbal").alias("amount")))


def costs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Cost categories: discount granted per return flag (category, cost)."""
    return (lineitem.groupBy(F.col("l_returnflag").alias("category"))
            .agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("cost")))


def benefits_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Benefit categories per line status: (category, units, unit_value)."""
    return (lineitem.groupBy(F.col("l_linestatus").alias("category"))
            .agg(F.count(F.lit(1)).alias("units"),
                 F.avg(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("unit_value")))
