"""The pipeline against its stages done by hand."""

from hashlib import sha256
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from edge_texts import EDGE_ROWS
from orderline_kpi.llm import bpe, decontaminate, line_dedup, quality_rules, simhash
from orderline_kpi.sources.scratch import shared_root, work_scope
from llm_fixtures import documents, package_for_workers  # noqa: F401


def test_stages_apply_their_operators(spark, tables_dir, tmp_path):
    docs = spark.read.parquet(f"{tables_dir}/documents.parquet")
    columns = docs.columns
    kept = [row["doc_id"] for row in quality_rules.apply_rules(docs).where("kept").collect()]
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality_rules"](spark, docs, tables_dir)
    assert first.columns == columns and sorted(row["doc_id"] for row in first.collect()) == sorted(kept)
    second = stages["line_dedup"](spark, first, tables_dir)
    assert second.columns == columns and second.count() == first.count()
    lines = {row["doc_id"]: row["text"] for row in line_dedup.remove_lines(first).collect()}
    assert {row["doc_id"]: row["text"] for row in second.collect()} == lines
    assert second.where("n_chars <> char_length(text)").isEmpty()
    third = stages["simhash_near_dedup"](spark, second, tables_dir)
    groups = simhash.near_duplicates(second, ["doc_id"]).collect()
    assert sorted(row["doc_id"] for row in third.collect()) == sorted({row["component_id"] for row in groups})
    fourth = stages["benchmark_decontamination"](spark, third, tables_dir)
    benchmark = spark.read.parquet(f"{tables_dir}/benchmark.parquet")
    clean = decontaminate.Decontaminator(third, benchmark).documents().where("n_hit = 0")
    assert fourth.columns == columns
    assert sorted(row["doc_id"] for row in fourth.collect()) == sorted(row["id"] for row in clean.collect())
    ids = {row["doc_id"]: sha256(bytes(row["ids"])).hexdigest() for row in corpus_pipeline.run(spark, tables_dir).collect()}
    tokenizer = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    assert ids == {row["doc_id"]: sha256(tokenizer.encode(row["text"])).hexdigest() for row in fourth.collect()}


def test_edge_rows_pass_every_stage(spark, documents, tmp_path):
    long = " ".join(f"word{k}" for k in range(60))
    docs = documents(*EDGE_ROWS, (70, long), (71, long), (72, None), (73, long + " and a benchmark item of ten words in a row here"))
    # On one host most would fail, and the host with them.
    docs = docs.withColumn("source", F.col("doc_id").cast("string"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "benchmark item of ten words in a row")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    rows = {row["doc_id"]: row["n_tokens"] for row in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {7, 70} <= set(rows) and 72 not in rows and 73 not in rows


def test_last_stage_decodes_what_it_encodes(spark, documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = {1: "Two words, it's 2024.", 2: "", 3: None, 4: "\u00dcber \u65e5\u672c \U0001f600"}
    tokens = dict(corpus_pipeline.STAGES)["bpe_encoding"](spark, documents(*texts.items()), "")
    assert tokens.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"]
    for row in tokens.collect():
        ids = bpe.load(path).encode(texts[row["doc_id"]] or "")
        assert bytes(row["ids"]) == ids and row["n_tokens"] == len(ids) // 4
        assert row["decoded_sha256"] == sha256(bpe.join_pieces(ids, bpe.load_pieces(path)).encode()).hexdigest()


def test_no_documents(spark, documents, tmp_path):
    documents((1, "x")).where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_hand_on_columns_named_like_results(spark, documents, tmp_path):
    spark.createDataFrame([(1, "nowhere at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = " ".join(f"word{k}" for k in range(80))
    docs = documents((1, text), (2, text + "\n" + text), (None, text + " more")).withColumns({
        "kept": F.lit("kept"), "n_lines": F.lit(-7), "gone": F.lit("gone"), "base_failed": F.lit(3), "host_rate": F.lit("rate"),
        "fingerprint": F.lit("print"), "root": F.lit(1.5), "n_hit": F.lit("hit"), "items": F.lit(4)})
    extra = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        rows = after.select(*extra).distinct().collect()
        assert rows == docs.select(*extra).distinct().collect(), name
        docs = after


def test_a_run_leaves_its_result_alone_behind(spark, documents, tmp_path):
    root = Path(shared_root(spark).removeprefix("file:"))
    text = " ".join(f"word{k}" for k in range(80))
    documents((1, text), (2, text), (3, "short")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    before = set(root.iterdir()) if root.exists() else set()
    with work_scope():
        # The second document has lost its line to the first one and stays, empty.
        assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == 2
        assert [path.name.rsplit("-", 1)[0] for path in set(root.iterdir()) - before] == ["pipeline-bpe_encoding"]
    assert set(root.iterdir()) == before
