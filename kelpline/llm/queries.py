"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.llm import conversation_repair, hamming_search, host_rules, html_text, line_dedup, mixing, near_dedup, simhash, substrings, token_counts, warc, whitening, word_bpe
from kelpline.llm.tables import table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf: str) -> DataFrame:
    return warc.page_records(table(spark, sf, "pages").select("page_id", "url", "html"))


def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"), ranks=vocabulary("byte_bpe_50k.tiktoken"))
    return counted.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


def op3(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf, "documents").select("doc_id", "text"))


def op4(spark: SparkSession, sf: str) -> DataFrame:
    found = html_text.visible_text(table(spark, sf, "pages").select("page_id", "html"))
    return found.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op5(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken", "draws")


def op6(spark: SparkSession, sf: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    decoded = word_bpe.decode(word_bpe.encode(docs, path), path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


def op8(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    judged = host_rules.quality_rules(docs, with_text=False)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9(spark: SparkSession, sf: str) -> DataFrame:
    return hamming_search.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op10(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.similar_lines(table(spark, sf, "documents").select("doc_id", "text"))
    doc = lambda c: F.nullif(F.col(c), F.lit(line_dedup.LAST))
    return found.select(
        doc("at").alias("doc_id"), F.col("line").alias("line_no"), F.col("n").alias("n_tokens"),
        doc("first.at").alias("class_doc"), F.col("first.line").alias("class_line"),
        doc("match.at").alias("match_doc"), F.col("match.line").alias("match_line"), "kept", F.col("links").alias("n_links"),
    )


def op11(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf, "documents").select("doc_id", "text"))


def op12(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    found = conversation_repair.summarize(conversation_repair.repair(conversation_repair.damaged(rows))).drop("conv_id")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().select(key, "conv_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    joined = every.join(found.withColumn("_found", F.lit(True)), "key", "left")
    # a conversation of which no row is left has nothing to repair
    none = lambda c, v: F.when(F.col("_found"), F.col(c)).otherwise(F.lit(v)).alias(c)
    nothing = hashlib.sha256().hexdigest()
    return joined.select("conv_id", *(none(c, 0) for c in counts), none("audit", ""), none("repaired_sha256", nothing))


def op13(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_seekable_warc": op1,
        "op2_token_counts": op2,
        "op3_compact_windows": op3,
        "op4_html_text": op4,
        "op5_source_mix": op5,
        "op6_word_bpe": op6,
        "op7_minhash_near_dedup": op7,
        "op8_host_quality_rules": op8,
        "op9_hamming_search": op9,
        "op10_line_dedup": op10,
        "op11_simhash_near_dedup": op11,
        "op12_conversation_repair": op12,
        "op13_qdwh_whitening": op13,
    }
