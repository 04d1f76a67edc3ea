"""SimHash near-duplicates through an inverted index of positional fingerprint bytes.

Two 64-bit fingerprints that differ in at most three bits agree in at least five of their eight
bytes.  The index therefore lists fingerprints by the bytes they have at given positions.  A
list for one byte would hold a 256th of all fingerprints, so its keys combine four positions: of any
five positions, four are the key of one of the 14 lists that a fingerprint stands in.  Within a
list the shared positional bytes of each pair are tallied, pairs with fewer than five are
dropped, and the rest are verified bit by bit.

Equal fingerprints are one entry.  Of the links found in a list only a spanning forest is
written, so a dense group costs a row for each member and not for each pair.  Of a list
longer than ``block`` finer lists are made: linked fingerprints of it agree in one more byte at least, so each
entry goes to a list for each of the other positions, and where bytes are not enough to parts of the
bits left.  That is four rows an entry, however long the list is, and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import filled, groups_of
from orderline_kpi.llm.components import connected_components
from orderline_kpi.sources.scratch import WorkArea

_CHUNK = 1 << 16


def covering_keys(size: int = 4, agreeing: int = 5) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any ``agreeing`` of the eight contain one of them.

    Chosen greedily: 14 sets of four positions for five agreeing bytes.
    """
    left = set(combinations(range(8), agreeing))
    keys: list[tuple[int, ...]] = []
    while left:
        best = max(combinations(range(8), size), key=lambda key: sum(set(key) <= set(five) for five in left))
        keys.append(best)
        left = {five for five in left if not set(best) <= set(five)}
    return keys


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included, as an unsigned integer.

    Words stand between ASCII white space, with A-Z in lower case.  With fewer words than a
    shingle has, all of them are the one shingle; without any the fingerprint is 0.
    """
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b], 42)
         for a, b in zip(starts[:n].tolist(), (ends[min(shingle, len(words)) - 1:] - 1).tolist(), strict=True)),
        np.uint64, n,
    )
    counts = sum(
        np.unpackbits(hashes[k:k + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        for k in range(0, n, _CHUNK)
    )
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, columns: list[str], text: Column, shingle: int = 3) -> DataFrame:
    """``columns`` of ``docs`` and the ``fingerprint`` of the text, as a signed long."""
    rows = docs.select(*columns, filled(text).alias("__text"))
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.drop("__text").schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = np.array([fingerprint(x, shingle) for x in batch["__text"]], np.uint64)
            yield batch[columns].assign(fingerprint=prints.view(np.int64))

    return rows.mapInPandas(run, f"{schema}, fingerprint long")


def _signed(bits: int) -> int:
    return int(np.uint64(bits).view(np.int64))


def key_masks() -> list[int]:
    """The bits of a fingerprint that each key consists of."""
    return [sum(255 << 8 * at for at in key) for key in covering_keys()]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """Masks with more bits, one of which any two fingerprints agree in that agree in ``mask`` and differ in at most ``max_bits``.

    The bits outside of the mask are cut into one part more than can differ: beside four bytes, these are the other bytes.
    """
    free = [bit for bit in range(64) if not mask >> bit & 1]
    if len(free) <= max_bits:
        return []
    return [mask | sum(1 << int(bit) for bit in part) for part in np.array_split(free, max_bits + 1)]


def _forest(prints: np.ndarray, max_bits: int) -> list[tuple[np.uint64, np.uint64]]:
    """Links that connect what pairs of at most ``max_bits`` differing bits connect, as few as possible."""
    need = 8 - max_bits
    root, links = np.arange(len(prints)), []
    for i in range(1, len(prints)):
        apart = prints[:i] ^ prints[i]
        shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(1)
        near = np.flatnonzero(shared >= need)
        near = near[np.bitwise_count(apart[near]) <= max_bits]
        for tree, at in zip(*np.unique(root[near], return_index=True), strict=True):
            links.append((prints[i], prints[near[at]]))
            root[root == tree] = i
    return links


def _search(max_bits: int):
    """Links within the lists of a partition that is sorted by list."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, begins, ends in groups_of(batches, ["mask", "value"]):
            prints = part["fingerprint"].to_numpy().view(np.uint64)
            found = [link for a, b in zip(begins, ends, strict=True) if b - a > 1 for link in _forest(prints[a:b], max_bits)]
            found = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return run


def links(prints: DataFrame, work: WorkArea, max_bits: int = 3, block: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints, a spanning forest of each list's."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the index finds fingerprints that differ in at most three bits")
    found = _lists(prints, work, max_bits, block)
    lists = ["mask", "value"]
    return found.repartition(*lists).sortWithinPartitions(*lists).mapInPandas(_search(max_bits), "a long, b long")


def _lists(prints: DataFrame, work: WorkArea, max_bits: int, block: int) -> DataFrame:
    """``mask, value, fingerprint``: the lists of the index, each fingerprint in every list it has to be searched in."""
    fp = F.col("fingerprint")
    masks = key_masks()
    rows = prints.select(fp, F.explode(F.array(*[F.lit(_signed(mask)) for mask in masks])).alias("mask"))
    short = None
    while True:
        rows = rows.select("mask", fp.bitwiseAND(F.col("mask")).alias("value"), "fingerprint")
        finer = {mask: finer_masks(mask, max_bits) for mask in masks}
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        # Below that many free bits all of a list are linked, and it is short.
        long = work.table(sizes.where(
            (F.col("n") > block) & (F.bit_count("mask") < 64 - max_bits)).select("mask", "value"), "long_lists")
        here = rows.join(long, ["mask", "value"], "left_anti")
        short = here if short is None else short.union(here)
        if long.isEmpty():
            return short
        parts = F.create_map(*[x for mask, more in finer.items() for x in (
            F.lit(_signed(mask)), F.array(*[F.lit(_signed(m)) for m in more]).cast("array<bigint>"))])
        rows = work.table(rows.join(long, ["mask", "value"], "left_semi").select(
            F.explode(parts[F.col("mask")]).alias("mask"), "fingerprint").distinct(), "finer")
        masks = sorted({m for more in finer.values() for m in more})


def near_duplicates(
    docs: DataFrame, columns: list[str], id_column: str = "doc_id", text_column: str = "text",
    max_bits: int = 3, shingle: int = 3, block: int = 2048,
) -> DataFrame:
    """``columns`` of each row of ``docs``, its ``fingerprint``, ``component_id`` and ``root``.

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits; ``component_id`` is the
    smallest id that links reach, null if there is no other; ``root`` is the component's smallest fingerprint.  Null and empty texts have the
    fingerprint 0 and are linked like any others.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = WorkArea(spark, "simhash")
    renamed = [F.col(c).alias(f"c{k}") for k, c in enumerate(columns)]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), *renamed)
    rows = work.table(
        fingerprints(rows, [c for c in rows.columns if c != "text"], F.col("text"), shingle), "fingerprints")
    prints = work.table(rows.groupBy("fingerprint").agg(F.min("id").alias("id")), "distinct")
    roots = connected_components(links(prints, work, max_bits, block), work)
    rooted = prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "id", F.coalesce("root", "fingerprint").alias("root"))
    rooted = work.table(rooted, "rooted")
    named = work.table(rooted.join(
        rooted.groupBy("root").agg(F.min("id").alias("component_id")), "root"
    ).select("fingerprint", "component_id", "root"), "components")
    return rows.join(named, "fingerprint").select(
        *[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], "fingerprint", "component_id", "root")


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = 3, shingle: int = 3,
) -> DataFrame:
    """The row of each component of near-duplicates that has the smallest id, with all its columns.

    Null ids come first; among rows with one id the text's hash decides; of rows equal in id and
    text any one stays.
    """
    text = filled(F.col(text_column))
    key = {
        "__key": F.xxhash64(F.col(id_column).isNull(), F.col(id_column), text),
        "__key2": F.xxhash64(text, F.lit(1), F.col(id_column)),
    }
    keyed = docs.withColumns(key)
    marked = near_duplicates(
        keyed.select(F.col(id_column).alias("id"), *key, text.alias("text")), ["id", *key], "id", "text", max_bits, shingle)
    # The smallest row of a component, by partial minima; a component is named by its fingerprints' root.
    stays = marked.groupBy("root").agg(F.min(F.struct("id", *key)).alias("row")).select("row.__key", "row.__key2")
    stays = WorkArea(docs.sparkSession, "simhash").table(stays, "stays")
    return keyed.join(stays, list(key), "left_semi").dropDuplicates(list(key)).select(*docs.columns)
