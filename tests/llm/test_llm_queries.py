"""The queries that SQL can express, value for value; and that every operator has a query."""

import pytest

from orderline_kpi.llm.oracle import ORACLE_SQL
from orderline_kpi.llm.queries import QUERIES

import __spark_entry__ as contract
from llm_fixtures import documents, package_for_workers  # noqa: F401


def rows_of(names, rows):
    """Rows with columns by name, in a fixed order."""
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(row[k] for k in order) for row in rows), key=repr)


def same(frame, connection, sql):
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    assert sorted(frame.columns) == sorted(names)
    return rows_of(frame.columns, frame.collect()) == rows_of(names, expected.fetchall())


def test_each_operator_has_one_query():
    assert [name.split("_")[0] for name in QUERIES] == sorted(
        (f"op{k}" for k in range(1, 14)), key=lambda name: int(name[2:]))
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, spark, duck, tables_dir):
    assert same(QUERIES[name](spark, tables_dir), duck, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_edge_rows_equal_sql(name, spark, documents, tmp_path):
    import duckdb

    from edge_texts import EDGE_ROWS

    # The SQL copies the words of a text for each of its words, so the long one is shorter here.
    rows = [(doc, text and " ".join(text.split(" ")[:3000])) for doc, text in EDGE_ROWS]
    documents(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    items = [(1, "one"), (2, None), (3, ""), (None, "three words here"), (4, "word1 and1 word2 and2 word3 and3 word4 and4 word5 and5 word6"),
             (4, "the same row")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    turns = [(1, None, "user", None), (1, 2, None, "a"), (None, 1, "user", "b"), (100, 1, "user", "c"), (101, 0, "user", "d"),
             (101, 1, "assistant", "d"), (101, 2, "user", "e"), (101, 3, "x", "f"), (101, 4, "x", "f"), (101, 5, "x", "\U0001f600")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert same(QUERIES[name](spark, str(tmp_path)), connection, ORACLE_SQL[name])


@pytest.mark.parametrize("name", [
    n for n in QUERIES if n not in ("op4_quality_classifier", "op6_warc", "op11_conversation_repair", "op13_prefix_trie")])
def test_empty_documents_give_an_empty_result(name, spark, documents, tmp_path):
    documents((1, "x")).where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
