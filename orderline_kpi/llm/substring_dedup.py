"""Substring deduplication by fixed-block anchors.

A repeat is a window of consecutive words that also starts earlier in the corpus.  Every document
is cut into non-overlapping reference blocks of half a window, so whatever window repeats,
its earlier occurrence contains a whole block.  Blocks are indexed by hash, and every
rolling block of every document probes the index; hits are probes behind the first block
of their hash.  Around hits and the blocks they hit, windows are extended word by word: each
window there is compared as a whole (80 bits of hash) with all others, and those that are not the
first of their kind are repeats.  Overlapping repeats make up the maximal ones.

Documents are ordered by id; rows with the same id by their text, and rows that agree in both
are one document.  A null id comes first.

Probes outnumber everything else, so they are shuffled packed, at about 7 bytes each, and each batch
first settles among its own.  Of equal blocks of a batch only the first anchor meets those of other batches; the hits behind
it are dealt by document.  So a passage that a third of all documents share puts one entry per batch and
block into the bucket of its hash.  Buckets answer by document too, in a row for each destination and
not for each document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from orderline_kpi.llm.common import filled
from orderline_kpi.llm.packing import SCHEMA, bucket_bits, bucket_of, pack, unpack
from orderline_kpi.sources.scratch import WorkArea

_BATCH_WORDS = 1 << 19
_BUCKET_BYTES = 1 << 24  # of text; a word takes two at least, about six in most languages
_HOME_BYTES = 1 << 26
_NO_ID = -(1 << 63)


def _combine(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of each run of ``width`` numbers."""
    factors = np.random.default_rng(seed).integers(1 << 63, size=width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(hashes) - width + 1
    total = np.zeros(max(0, n), np.uint64)
    for j in range(width if n > 0 else 0):
        total += hashes[j:j + n] * factors[j]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0x9E3779B97F4A7C15)
    return total ^ (total >> np.uint64(29))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _settle(
    keys: list[np.ndarray], place: list[np.ndarray], anchor: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of entries with equal keys: the first anchors that have later entries, and those entries.

    ``place`` (id, tie, position) orders the entries; equal places are one entry.
    """
    order = np.argsort(keys[0])
    same = keys[0][order[1:]] == keys[0][order[:-1]]
    order = order[np.r_[False, same] | np.r_[same, False]] if len(order) else order
    if not len(order):
        return order, order
    order = order[np.lexsort([column[order] for column in (*place[::-1], *keys[::-1])])]
    begins = np.zeros(len(order), bool)
    begins[0] = True
    for key in keys:
        begins[1:] |= key[order[1:]] != key[order[:-1]]
    group, at = np.cumsum(begins) - 1, np.arange(len(order))
    firsts = np.minimum.reduceat(np.where(anchor[order], at, len(order)), np.flatnonzero(begins))
    first = np.minimum(firsts[group], len(order) - 1)
    later = at > firsts[group]
    later &= np.logical_or.reduce([column[order] != column[order[first]] for column in place])
    return order[np.unique(first[later])], order[later]


_PLACE = [np.int64, np.uint32, np.uint32]


def _homeward(place: list[np.ndarray], bits: int, offset: int = 0) -> pd.DataFrame:
    """Packed places, by the document they belong to; ``bits``: of the number of destinations."""
    mixed = (place[0].view(np.uint64) + place[1]) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return pack(bucket_of(mixed, bits).astype(np.int32) + np.int32(offset), place, [True] * 3)


class _Round:
    """One exchange of entries (key, place) by key, which finds those behind the first of their key.

    What a batch has settled itself needs no meeting: it goes through destinations of its own, dealt by document, behind
    the buckets.  Buckets answer in the same form, one row for each destination.
    """

    def __init__(self, key_types: list[type], step: int, with_first: bool, bucket_bits: int, home_bits: int) -> None:
        self.types = [*key_types, *_PLACE, np.uint8]
        self.deltas = [False] * len(key_types) + [True, True, True, False]
        self.step, self.with_first, self.bits, self.home_bits = step, with_first, bucket_bits, home_bits

    def send(self, hashes: np.ndarray, more: list[np.ndarray], place: list[np.ndarray]) -> pd.DataFrame:
        """Packed entries, in the order of ``place``."""
        keys = [hashes, *more]
        first, later = _settle(keys, place, place[2] % self.step == 0)
        found = np.zeros(len(hashes), np.uint8)
        if self.with_first:
            found[first] = 1  # others have to see it still
        open_ = np.ones(len(hashes), bool)
        open_[later] = False
        shift = 64 - self.bits - 8 * np.dtype(self.types[0]).itemsize
        kept = (hashes >> np.uint64(max(0, shift))).astype(self.types[0])
        columns = [column[open_] for column in (kept, *more, *place, found)]
        return pd.concat([
            pack(bucket_of(hashes[open_], self.bits), columns, self.deltas),
            _homeward([column[~open_] for column in place], self.home_bits, 1 << self.bits)], ignore_index=True)

    def receive(self) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            if rows["bucket"].iloc[0] >= 1 << self.bits:
                return rows.assign(bucket=rows["bucket"] - (1 << self.bits))
            *keys, ids, ties, at, found = unpack(rows, self.types, self.deltas)
            first, later = _settle(keys, [ids, ties, at], at % self.step == 0)
            behind = np.union1d(np.flatnonzero(found), np.union1d(first, later) if self.with_first else later)
            behind = behind[np.lexsort((at[behind], ties[behind], ids[behind]))]
            return _homeward([ids[behind], ties[behind], at[behind]], self.home_bits)

        return run


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for each document of a destination, with all its positions."""
    ids, ties, at = unpack(rows, _PLACE, [True] * 3)
    order = np.lexsort((at, ties, ids))
    ids, ties, at = ids[order], ties[order], at[order]
    begins = np.flatnonzero(np.r_[len(ids) > 0, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])])
    return pd.DataFrame({
        "id": ids[begins], "tie": ties[begins].astype(np.int64),
        "positions": pd.Series(np.split(at.astype(np.int32), begins[1:]) if len(begins) else [], dtype=object),
    })


def _batches_of_words(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    """Rows in the order of their documents, with their words, at most about half a million words at once."""
    for frame in frames:
        rows, words, n = [], [], 0
        for k, text in enumerate(frame["text"]):
            rows.append(k)
            words.append(text.encode("utf-8").split())
            n += len(words[-1])
            if n >= _BATCH_WORDS:
                yield _in_order(frame.iloc[rows], words)
                rows, words, n = [], [], 0
        if rows:
            yield _in_order(frame.iloc[rows], words)


def _in_order(frame: pd.DataFrame, words: list[list[bytes]]) -> tuple[pd.DataFrame, list[list[bytes]]]:
    order = np.lexsort((frame["tie"].to_numpy(), frame["id"].to_numpy()))
    return frame.iloc[order], [words[k] for k in order]


def _probes(window: int, first: _Round) -> Callable:
    block = window // 2

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, words in _batches_of_words(frames):
            lengths = np.array([len(own) for own in words])
            hashes = _combine(_word_hashes([word for own in words for word in own]), block, 1)
            doc = np.repeat(np.arange(len(words)), lengths)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            use = np.flatnonzero((lengths[doc] >= window) & (at <= lengths[doc] - block))
            place = [frame["id"].to_numpy()[doc[use]], frame["tie"].to_numpy().astype(np.uint32)[doc[use]],
                     at[use].astype(np.uint32)]
            yield first.send(hashes[use], [], place)

    return run


def _windows(window: int, second: _Round) -> Callable:
    block = window // 2

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, words in _batches_of_words(frames):
            keys, more, ids, ties, places = [], [], [], [], []
            for own, hits, doc, tie in zip(words, frame["positions"], frame["id"], frame["tie"], strict=True):
                # A window has the block at an offset of 0 to window - block.
                reach = np.zeros(len(own) + 1, np.int32)
                np.add.at(reach, np.maximum(0, hits - (window - block)), 1)
                np.add.at(reach, hits + 1, -1)
                starts = np.flatnonzero(np.cumsum(reach)[:len(own) - window + 1])
                hashes = _word_hashes(own)
                keys.append(_combine(hashes, window, 2)[starts])
                more.append((_combine(hashes, window, 3)[starts] >> np.uint64(48)).astype(np.uint16))
                ids.append(np.full(len(starts), doc, np.int64))
                ties.append(np.full(len(starts), tie, np.uint32))
                places.append(starts.astype(np.uint32))
            join = np.concatenate
            yield second.send(join(keys), [join(more)], [join(ids), join(ties), join(places)])

    return run


def _cut(window: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, copy, starts in zip(frame["text"], frame["copy"], frame["positions"], strict=True):
                words = text.encode("utf-8").split()
                if copy is True and len(words) >= window:
                    out.append((len(words), len(words), ""))
                    continue
                if starts is None or not len(starts):
                    out.append((len(words), 0, b" ".join(words).decode("utf-8")))
                    continue
                reach = np.zeros(len(words) + 1, np.int32)
                np.add.at(reach, starts, 1)
                np.add.at(reach, starts + window, -1)
                keep = (np.cumsum(reach)[:-1] == 0).tolist()
                kept = [word for word, stays in zip(words, keep, strict=True) if stays]
                out.append((len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")))
            result = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
            yield result.assign(id=frame["id"].to_numpy())[["id", "n_words", "n_removed", "kept"]]

    return run


def remove_repeats(
    docs: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined by spaces.

    A word goes if a window of ``window`` words (an even number) around it also starts earlier.  Words stand
    between ASCII white space; null texts have none.  Each text is judged as it came, not
    by what is left of others.  Ids are integers.  An empty table gives an empty result.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number")
    spark = docs.sparkSession
    text = filled(F.col(text_column))
    kind = docs.select(id_column).schema[0].dataType.simpleString()
    # Both joins below shuffle just these rows and columns by document, so Spark does it once.
    texts = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"), text.alias("text"),
    )
    copies, n_bytes = _copies(texts, WorkArea(spark, "substrings"))
    own = texts.join(copies, ["id", "tie"], "left_anti")
    # Buckets and destinations are read one at a time, so their numbers grow with the text.
    bits, home_bits = min(30, bucket_bits(spark, n_bytes, _BUCKET_BYTES)), min(30, bucket_bits(spark, n_bytes, _HOME_BYTES))
    first = _Round([np.uint32], window // 2, True, bits, home_bits)
    second = _Round([np.uint64, np.uint16], 1, False, bits, home_bits)

    def exchanged(entries: DataFrame, by: _Round) -> DataFrame:
        answers = entries.groupBy("bucket").applyInPandas(by.receive(), SCHEMA)
        return answers.groupBy("bucket").applyInPandas(_by_document, "id long, tie long, positions array<int>")

    hits = exchanged(own.mapInPandas(_probes(window, first), SCHEMA), first)
    repeats = exchanged(
        texts.join(hits, ["id", "tie"]).select("id", "tie", "text", "positions").mapInPandas(_windows(window, second), SCHEMA),
        second)
    marked = texts.join(repeats, ["id", "tie"], "left").join(
        copies.withColumn("copy", F.lit(True)), ["id", "tie"], "left")
    cut = marked.select("id", "text", "copy", "positions").mapInPandas(
        _cut(window), "id long, n_words long, n_removed long, kept string")
    return cut.withColumn("id", F.nullif("id", F.lit(_NO_ID)).cast(kind)).withColumnRenamed("id", id_column)


def _copies(texts: DataFrame, work: WorkArea) -> tuple[DataFrame, int]:
    """The documents (id, tie) whose whole text an earlier one has too, and the bytes of all rows.

    They need no search: their windows all start earlier, and no window starts first in them.
    """
    keys = work.table(texts.groupBy("id", "tie", F.md5(F.col("text").cast("binary")).alias("digest")).agg(
        F.sum(F.octet_length("text").cast("long")).alias("n_bytes")), "digests")
    firsts = keys.groupBy("digest").agg(F.min(F.struct("id", "tie")).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = work.table(firsts.where("n > 1"), "copied")
    copies = keys.join(firsts, "digest").where(F.struct("id", "tie") > F.col("first")).select("id", "tie")
    return work.table(copies, "copies"), keys.agg(F.sum("n_bytes")).first()[0] or 0
