"""Registered queries of the operators: each reads its whole table with production parameters."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, conversation_repair, license_scan, line_dedup, ngram_join, packing, periodic_runs, permutation_index, pii, quality_classifier, quality_rules, source_mix, substring_dedup
from tessera.llm.oracle import LINE_DEDUP, SUBSTRING_DEDUP
from tessera.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, disguised identifiers included."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix to target weights takes from every document."""
    return source_mix.taken_words(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group and number of links of every document."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, packed into sequences."""
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start earlier."""
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: its own evidence and its site's (source, and language within it)."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed rules and n-gram likelihood ratio for every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs."""
    return line_dedup.report(table(spark, sf_dir, "documents"))


def damaged_rows(conversations: DataFrame) -> DataFrame:
    """Conversation rows under the damage that their checksum names: 0 drops, 1 empties, 2 strips sentence ends, 3 repeats, 4 sets user."""
    spaced = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    hurt = spaced.withColumn("damage", F.crc32(name) % 20)
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("damage") == 0, 0).when(F.col("damage") == 3, 2).otherwise(1)
    return conversation_repair.rows_of(hurt.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies")), copies=F.col("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, after the damage."""
    return conversation_repair.repair(damaged_rows(table(spark, sf_dir, "conversations")))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """Documents, every tenth (by checksum of its id) with words from some place on repeating with a period; a null id leaves its text."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    marked = marked.withColumn("g", g).withColumn("a", F.when(n > 0, F.col("g") % n))
    marked = marked.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("long"))
    tail = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return marked.select("doc_id", F.when(n > 0, F.concat_ws(" ", tail)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and its text without the repeats."""
    found = periodic_runs.find_runs(repeated_tails(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    out = found.withColumn("r", longest).withColumn("length", -F.col("r.l"))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("r.start").alias("start"), "length", F.col("r.period").alias("period"),
                      F.floor(F.lit(1000) * F.col("length") / F.col("r.period")).cast("long").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the bytes that they decode to."""
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


LLM_QUERIES: dict[str, Query] = {
    "op1_personal_data": op1_personal_data,
    "op2_permutation_index": op2_permutation_index,
    "op3_source_mix": op3_source_mix,
    "op4_ngram_join": op4_ngram_join,
    "op5_packing": op5_packing,
    "op6_license_scan": op6_license_scan,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_byte_bpe": op13_byte_bpe,
}
LLM_ORACLE_SQL: dict[str, str] = {"op7_substring_dedup": SUBSTRING_DEDUP, "op10_line_dedup": LINE_DEDUP}
