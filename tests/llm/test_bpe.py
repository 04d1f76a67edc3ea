from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from edge_texts import EDGE_ROWS
from orderline_kpi.llm import bpe
from orderline_kpi.llm.queries import QUERIES
from orderline_kpi.llm.suffix_automaton import SuffixAutomaton
from llm_fixtures import documents, package_for_workers  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def reference(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_whole_table(spark, tables_dir, library):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{tables_dir}/documents.parquet").collect()}
    rows = QUERIES["op2_bpe"](spark, tables_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids, decoded = reference(library, texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids) // 4
        assert row["ids_sha256"] == sha256(ids).hexdigest()
        assert row["decoded_sha256"] == sha256(decoded.encode()).hexdigest()


def test_edge_rows(documents, library):
    docs = documents(*EDGE_ROWS, (20, "a<|endoftext|>b <|startoftext|>"), (21, "it's <|END"))
    rows = bpe.round_trip(docs, PATH, ["doc_id", "text"]).collect()
    assert len(rows) == len(EDGE_ROWS) + 2
    for row in rows:
        assert (bytes(row["ids"]), row["decoded"]) == reference(library, row["text"])


def test_decode_of_encode_equals_the_round_trip(documents):
    docs = documents((1, "Some Words, and 12 more"), (2, None))
    apart = bpe.decode(bpe.encode(docs, PATH, ["doc_id"]), PATH, ["doc_id"]).collect()
    at_once = bpe.round_trip(docs, PATH, ["doc_id"]).select("doc_id", "decoded").collect()
    assert sorted(apart) == sorted(at_once)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(
    "abcdefghilmnorstuxyzABCEIST  \n'!?.,-#1290\u00e9\u00e8\u00df\u0130\u03a3\u65e5\u0301\u00bd\u00b2\U0001f600\x1c\x85\u2009"), max_size=60))
def test_any_text_equals_the_library(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text_equals_the_library, "t") else test_any_text_equals_the_library.t
    test_any_text_equals_the_library.t = library
    assert bpe.load(PATH).encode(text) == reference(library, text)[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", max_size=6), max_size=12), st.text("abcd", max_size=40))
def test_suffix_automaton_lists_the_words_that_end_at_each_place(words, text):
    numbers = {word: k for k, word in enumerate(words)}
    automaton = SuffixAutomaton(numbers)
    expected = [(at, numbers[text[start:at + 1]], at + 1 - start) for at in range(len(text)) for start in range(at + 1)
                if text[start:at + 1] in numbers]
    assert list(automaton.matches(text)) == expected
    # No automaton of these parts has more than two states for each character.
    assert len(automaton.length) <= 2 * sum(map(len, numbers)) + 1


def test_suffix_automaton_takes_long_repeats_and_any_character():
    automaton = SuffixAutomaton({"a" * 5000: 1, "a": 2, "\U0001f600b": 3})
    assert list(automaton.matches("xa\U0001f600b")) == [(1, 2, 1), (3, 3, 2)]
    found = list(automaton.matches("a" * 5001))
    assert [m for m in found if m[1] == 1] == [(4999, 1, 5000), (5000, 1, 5000)] and len(found) == 5003
