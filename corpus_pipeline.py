"""The corpus pipeline: documents through cleaning, deduplication and decontamination to token ids."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderline_kpi.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from orderline_kpi.llm.common import read_table, share_package
from orderline_kpi.sources.scratch import WorkArea, work_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document goes if more than this share of its words stand in passages of the benchmark.
MAX_CONTAMINATED = 0.0


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """What an operator reads, and the whole row in one column, whose name no operator uses for a result."""
    return docs.select(*needed, F.struct(*docs.columns).alias("__row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with the columns they came with.

    Null and empty texts are rejected; repeated rows are judged one by one; an empty table gives an empty result.
    """
    judged = quality_rules.apply_rules(_carried(docs, "source", "text"), ["__row"])
    return judged.where("kept").select("__row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document or line has too, or nearly.

    Of the columns only ``text`` changes, and ``n_chars``, which follows it.  A document that has nothing left stays, with an
    empty text; a null text stays null; rows equal in id and text lose the same lines.
    """
    left = line_dedup.remove_lines(_carried(docs, "doc_id", "text"), ["__row", "text"])
    columns = {c: F.col("__row").getField(c) for c in docs.columns}
    columns["text"] = F.col("text")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("gone") > 0, F.char_length("text")).otherwise(columns["n_chars"]).cast(
            docs.schema["n_chars"].dataType)
    return left.select(*[c.alias(name) for name, c in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    The stage follows the contract of op3 (3-word shingles, at most 3 bits), not a similarity of 0.8 over
    five words; on the raw documents of sf0.1 that links 4 of 44 such pairs (README).
    """
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs.

    Null and empty texts have none; rows equal in id and text stay or go together; without items every document stays.
    """
    found = decontaminate.Decontaminator(docs, read_table(spark, sf_dir, "benchmark"))
    return found.clean_documents(docs, MAX_CONTAMINATED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each document the id, the token ids of its text, their number, and the digest of the text they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.round_trip(docs, path, ["doc_id"]).select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokens),
]

#: Fuzzy lines, fingerprints and token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result written and read again as the next one's input.

    The working tables of a stage, and its input, go once its result is written; that of the last stage stays.
    """
    docs, before = read_table(share_package(spark), sf_dir, "documents"), None
    for name, stage in STAGES:
        work = WorkArea(spark, f"pipeline-{name}")
        with work_scope():
            docs = work.table(stage(spark, docs, sf_dir), name)
        if before:
            before.close()
        before = work
    return docs
