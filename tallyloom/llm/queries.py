"""Queries of the operators in this package; each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import archives, bpe, chats, decontaminate, lines, minhash, pages, quality, repair, secrets, skips, substrings, toxicity
from tallyloom.session import read_table, saved


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.format_chats(read_table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = archives.write_packages(read_table(spark, sf_dir, "pages"))
    return archives.read_package_files(packages).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = saved(toxicity.score_toxicity(docs, toxicity.fit(docs, labels), lang="lang"), "scores")
    return toxicity.flagged(scored, saved(toxicity.thresholds(scored, labels), "thresholds")).withColumnRenamed("id", "doc_id")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeated_passages(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.withColumnRenamed("id", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read_table(spark, sf_dir, "documents"), counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{secrets.KINDS[kind]}")

    return secrets.find_secrets(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), *map(count, range(3)), F.sha2(secrets.named(base), 256).alias("base_sha256"), secrets.named(F.col("spans")).alias("spans"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skips.fill_in_middle(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(skips.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = repair.damaged(read_table(spark, sf_dir, "conversations"))
    return repair.repair_conversations(chats).withColumnRenamed("conv", "conv_id")


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_decontamination, op3_html, op4_warc, op5_minhash, op6_toxicity, op7_substrings, op8_bpe, op9_line_dedup, op10_quality,
                                 op11_secrets, op12_fill_in_middle, op13_repair)}
ORACLES: dict[str, str] = {"op1_chat_format": chats.SQL, "op2_decontamination": decontaminate.SQL, "op4_warc": archives.SQL, "op9_line_dedup": lines.SQL,
                           "op11_secrets": secrets.SQL, "op12_fill_in_middle": skips.SQL,
                           "op13_repair": repair.SQL}
