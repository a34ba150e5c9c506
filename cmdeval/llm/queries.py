"""The registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bpe_count, chat, decontaminate, line_dedup, mixing, ngram_join, pq_dedup, prefix_trie,
               repair_binary, sentencepiece_scan, token_alignment, toxicity)
from .common import table


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_count.count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op1_pq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "evidence")


def op3_repair_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_binary.encode_and_read(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document, as counts and a checksum of its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op6_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op8_balanced_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_sentencepiece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document as a count and a checksum, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_scan.encode(docs)
    return coded.select("doc_id", "n_tokens", F.xxhash64("ids").alias("ids_hash"), "round_trip")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op11_wu_manber_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op12_fingerprint_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf_dir, "conversations")).drop("ref_conv_id", "ref_place")


def op13_csr_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pq_near_dedup": op1_pq_near_dedup,
    "op2_toxic_neighbours": op2_toxic_neighbours,
    "op3_repair_binary": op3_repair_binary,
    "op4_token_counts": op4_token_counts,
    "op5_line_dedup": op5_line_dedup,
    "op6_weighted_fair_mix": op6_weighted_fair_mix,
    "op7_snapshot_collapse": op7_snapshot_collapse,
    "op8_balanced_postings": op8_balanced_postings,
    "op9_sentencepiece_scan": op9_sentencepiece_scan,
    "op10_ngram_join": op10_ngram_join,
    "op11_wu_manber_leaks": op11_wu_manber_leaks,
    "op12_fingerprint_trie": op12_fingerprint_trie,
    "op13_csr_alignment": op13_csr_alignment,
}
