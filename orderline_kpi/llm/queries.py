"""Each operator of this package as a query over a whole table of one folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderline_kpi.llm import (
    bpe, conversation_repair, decontaminate, licenses, line_dedup, pii, prefix_trie, quality_model, quality_rules, sharding,
    simhash, substring_dedup, warc,
)
from orderline_kpi.llm.common import read_table, share_package
from orderline_kpi.sources.scratch import WorkArea

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"), n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), path, ["doc_id"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = quality_model.score(documents, quality_model.train(documents, labels))
    return scored.select(
        "doc_id", quality_model.is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(read_table(spark, sf_dir, "documents"), ["doc_id", "text"]).select(
        "doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), "gone",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = WorkArea(spark, "warc")
    path = work.file("archives")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    # The archives are parsed once; all sides of the assembly read what was found.
    captures = warc.assemble(work.table(warc.read_records(spark, path, with_payload=False), "records"))
    return captures.select(
        "page_id", F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"), "capture_id",
        F.col("request.record_id").alias("request_id"), F.col("request.http_head").alias("request_head"),
        F.col("metadata.record_id").alias("metadata_id"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.Decontaminator(documents, benchmark).documents().select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read_table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.BASE_KINDS)],
        F.sha2("base_text", 256).alias("base_sha256"), F.col("spans_text").alias("spans"),
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(
        conversation_repair.damage(read_table(spark, sf_dir, "conversations")))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("places", lambda place: place["phrase"])
    starts = F.transform(base, lambda place: place["start"])
    text_of = lambda places: F.array_join(F.array_sort(F.array_distinct(
        F.transform(places, lambda place: place["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), text_of(base).alias("base_labels"), text_of("places").alias("labels"),
        F.when(F.exists("places", lambda place: ~place["phrase"]), 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations")).drop("high", "low")


def _shared(query: Query) -> Query:
    return lambda spark, sf_dir: query(share_package(spark), sf_dir)


QUERIES: dict[str, Query] = {name: _shared(query) for name, query in {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_simhash": op3_simhash,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_dedup": op5_line_dedup,
    "op6_warc": op6_warc,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_pii": op9_pii,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_licenses": op12_licenses,
    "op13_prefix_trie": op13_prefix_trie,
}.items()}
