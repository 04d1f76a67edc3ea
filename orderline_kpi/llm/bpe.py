"""Exact BPE encoding and decoding for vocabularies with word ends.

A text is normalised and cut into pieces the way the tokenizer file says; each piece is encoded
by dynamic programming over its prefixes.  The suffix automaton of all tokens gives,
at each position, the tokens that end there.  Exactly one of them is the last token of the
prefix's encoding: the one that is compatible with the last token of the prefix before it.  That
token is the back-pointer of the position; following them from the end gives the ids.
No merge is ever applied, and the work is linear in the length of a piece.

Two tokens are compatible if BPE, run over both together, leaves them as they are.  That is
decided by undoing their merges, latest first, and looking whether a merge across the border
would have come earlier.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import filled
from orderline_kpi.llm.suffix_automaton import SuffixAutomaton

#: The pieces of this kind of tokenizer, and what its regular expressions call space.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|"
    r"[^\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\p{L}\p{N}]+"
)
WORD_END = "</w>"
_END = 0x1000  # added to the character of a byte that ends a piece

_MEMO_ITEMS = 300_000
_MEMO_BYTES = 64
_ROWS_OUT = 512


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Memo(dict):
    """Results of a function by argument, long ones apart; starts anew when it is full."""

    def __init__(self, function, items: int) -> None:
        self._function, self._items = function, items

    def __missing__(self, key):
        value = self._function(key)
        if len(value) <= _MEMO_BYTES:
            if len(self) >= self._items:
                self.clear()
            self[key] = value
        return value


class Bpe:
    """The tokenizer in a file of the tokenizers library.

    Supported are BPE models with the word end ``</w>`` whose merges make tokens with ascending
    ids, normalised by NFC and lower case and cut by ``PIECES``.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocabulary = spec["model"], spec["model"]["vocab"]
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if model["end_of_word_suffix"] != WORD_END or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError("not a tokenizer of the supported kind")
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._split = regex.compile(PIECES)
        characters = _byte_characters()
        self._to_characters = dict(enumerate(characters))
        symbols: dict[int, str] = {}
        for character in characters:
            symbols[vocabulary[character]] = character
            symbols[vocabulary[character + WORD_END]] = chr(ord(character) + _END)
        self._parts: dict[int, tuple[int, int]] = {}
        self._merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            # Parts that end a piece are written with the word end, like the whole.
            pair = vocabulary[left], vocabulary[right]
            number = vocabulary[left + right]
            if number <= max(pair):
                raise ValueError("merges must make tokens with ascending ids")
            self._parts[number], self._merged[pair] = pair, number
            symbols[number] = symbols[pair[0]] + symbols[pair[1]]
        self._fits: dict[int, bool] = {}
        # A token that BPE would not make of its own characters never occurs.
        reachable: set[int] = set()
        for number in sorted(symbols):
            parts = self._parts.get(number)
            if parts is None or (parts[0] in reachable and parts[1] in reachable and self._compatible(*parts, number)):
                reachable.add(number)
        self._automaton = SuffixAutomaton({symbols[number]: number for number in sorted(reachable)})
        self._encoded = Memo(self._encode_piece, _MEMO_ITEMS)

    def _compatible(self, left: int, right: int, bound: int = 1 << 30) -> bool:
        """Whether no merge across the border of two tokens comes before one within them.

        Of two equal merges the one further left comes first, so a merge across goes before
        an equal one in the right token but not before one in the left.
        """
        merged, parts = self._merged, self._parts
        while True:
            if merged.get((left, right), bound) < bound:
                return False
            if left > right and left in parts:
                bound, left = left, parts[left][1]
            elif right in parts:
                bound, right = right + 1, parts[right][0]
            elif left in parts:
                bound, left = left, parts[left][1]
            else:
                return True

    def _encode_piece(self, piece: str) -> bytes:
        text = piece.encode("utf-8").decode("latin-1").translate(self._to_characters)
        text = text[:-1] + chr(ord(text[-1]) + _END)
        # Of each position: the last token of the prefix that ends there, and where that token begins.
        last, begins = [-1] * len(text), [-1] * len(text)
        fits, automaton = self._fits, self._automaton
        number, length, nearest = automaton.number, automaton.length, automaton.nearest
        for at, end in automaton.longest_ends(text):
            while end:
                token, before = number[end], at - length[end]
                fit = True
                if before >= 0:
                    pair = last[before] << 20 | token
                    fit = fits.get(pair)
                    if fit is None:
                        if len(fits) >= _MEMO_ITEMS:
                            fits.clear()
                        fit = fits[pair] = self._compatible(last[before], token)
                if fit:
                    last[at], begins[at] = token, before
                    break
                end = nearest[end]
        ids, at = [], len(text) - 1
        while at >= 0:
            ids.append(last[at])
            at = begins[at]
        ids.reverse()
        return pack(f"<{len(ids)}I", *ids)

    def _encode_plain(self, text: str) -> bytes:
        # Letters are lowered one by one, so a sigma that ends a word is no exception.
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return b"".join(map(self._encoded.__getitem__, self._split.findall(lowered)))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if "<|" not in text:
            return self._encode_plain(text)
        return b"".join(
            pack("<I", self.special[part]) if part in self.special else self._encode_plain(part)
            for part in self._special.split(text)
        )


def join_pieces(ids: bytes, pieces: dict[int, str]) -> str:
    """The tokens of ids, joined by spaces, as the library does for files without a decoder."""
    return " ".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load_pieces(path: str) -> dict[int, str]:
    """The token of each id."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return {number: token for token, number in spec["model"]["vocab"].items()} | {
        token["id"]: token["content"] for token in spec["added_tokens"]}


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The tokenizer of a file, built once per process."""
    return Bpe(path)


def _per_text(docs: DataFrame, column: str, value: Column, columns: list[str], schema: str, work: Callable) -> DataFrame:
    """``columns`` of ``docs`` and what ``work`` makes of ``value``, a few rows at a time: results may be long."""
    rows = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)], value.alias(column))
    kept = [f"c{k}" for k in range(len(columns))]
    types = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), _ROWS_OUT):
                part = batch[first:first + _ROWS_OUT]
                yield part[kept].assign(**work(part[column]))

    return rows.mapInPandas(run, types + schema).withColumnsRenamed(dict(zip(kept, columns, strict=True)))


def encode(docs: DataFrame, path: str, columns: list[str], text_column: str = "text") -> DataFrame:
    """``columns`` of each row of ``docs``, and ``ids``: those of its whole text, in 4 bytes each, little-endian.

    A null text counts as empty and has no ids.  Special tokens written out in a text become
    their ids.  Repeated rows stay; an empty table gives an empty result.  Nothing is shuffled;
    ``path`` must be readable on all executors.
    """
    return _per_text(
        docs, "text", filled(F.col(text_column)), columns, "ids binary",
        lambda texts: {"ids": [load(path).encode(text) for text in texts]})


def decode(tokens: DataFrame, path: str, columns: list[str], ids_column: str = "ids") -> DataFrame:
    """``columns`` of each row of ``tokens``, and ``decoded``: the text of ``ids_column``; a null one has none."""
    return _per_text(
        tokens, "ids", F.col(ids_column), columns, "decoded string",
        lambda rows: {"decoded": [None if ids is None else join_pieces(ids, load_pieces(path)) for ids in rows]})


def round_trip(docs: DataFrame, path: str, columns: list[str], text_column: str = "text") -> DataFrame:
    """What ``encode`` and then ``decode`` of its ids return, in one pass over the texts."""
    def work(texts: pd.Series) -> dict[str, list]:
        ids = [load(path).encode(text) for text in texts]
        return {"ids": ids, "decoded": [join_pieces(row, load_pieces(path)) for row in ids]}

    return _per_text(
        docs, "text", filled(F.col(text_column)), columns, "ids binary, decoded string", work)
