"""Fuzzy line deduplication: MinHash, banding, exact Jaccard, distributed union-find.

Lines are compared in lower case with white space evened out.  The signature of a line is made of the
minima of many hashes over its character shingles; lines that agree in a band of the signature are
candidates, and a pair is linked if the Jaccard similarity of the two sets of shingles is at least
the threshold.  Of every component of linked lines the first one stays, in the order of
document id (null first), text hash and line number.  Lines without a visible character are left alone.

Signatures never leave the batch they are made in.  Packed entries of a few bytes per band meet in buckets;
equal lines are told by a line hash and settled there, in the batch already where they meet in one.
Within a band, lines are first compared with the commonest of them, which connects a group of near copies with as
many pairs as it has members.  Only pairs of members that are still apart are compared after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import filled, groups_of
from orderline_kpi.llm.components import connected_components
from orderline_kpi.llm.packing import SCHEMA, bucket_bits, bucket_of, pack, unpack
from orderline_kpi.sources.scratch import WorkArea

SHINGLE = 7
#: A character that is no white space, in any script; lines without one are left alone.
VISIBLE = r"(?U)[^\s\x1C-\x1F]"
BANDS, ROWS = 14, 5  # finds a pair of similarity 0.8 with a probability of 0.996, one of 0.85 with 0.9997
_BATCH_CHARS = 4 << 20
_CHUNK = 1 << 15
_BUCKET_ENTRIES = 1 << 21
_NO_ID = -(1 << 63)
_SMALL_BAND = 16
_CHARACTER_BITS, _LONG_LINE, _KNOWN_LINES = 9, 200, 2000
# An entry: band hash, line hash, marks, weight, place.  What a batch has settled: band, place, place of its head.
_TYPES = [np.uint32, np.uint64, np.uint8, np.uint16, np.int64, np.uint32, np.uint32]
_DELTAS = [False, False, False, False, True, True, True]
_SETTLED_TYPES = [np.int64, *_TYPES[4:], *_TYPES[4:]]
_SETTLED_DELTAS = [False] + [True] * 6
_FIRST_BAND, _FOLLOWED = 1, 2  # marks
_NO_GROUP = -1


def normal(line: str) -> str:
    """A line as it is compared."""
    return " ".join(line.lower().split())


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x7FEB352D)
    h ^= h >> np.uint32(15)
    return h


def signatures(lines: list[str]) -> np.ndarray:
    """The MinHash of each line's shingles; a line shorter than a shingle is one shingle."""
    n_hashes = BANDS * ROWS
    out = np.empty((len(lines), n_hashes), np.uint32)
    if not lines:
        return out
    draw = np.random.default_rng(7)
    factors = draw.integers(1 << 31, size=n_hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    masks = draw.integers(1 << 32, size=n_hashes, dtype=np.uint64).astype(np.uint32)
    points = np.frombuffer("".join(lines).encode("utf-32-le") + bytes(4 * SHINGLE), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(lengths) - lengths
    counts = np.maximum(1, lengths - SHINGLE + 1)
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(lines):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _CHUNK)))
        own = points[starts[begin]:starts[end - 1] + lengths[end - 1] + SHINGLE]
        hashes = np.zeros(len(own) - SHINGLE + 1, np.uint32)
        for j in range(SHINGLE):
            hashes *= np.uint32(0x01000193)
            hashes += own[j:j + len(hashes)]
        first = ends[begin:end] - counts[begin:end] - (ends[begin] - counts[begin])
        where = np.arange(counts[begin:end].sum()) + np.repeat(starts[begin:end] - starts[begin] - first, counts[begin:end])
        hashes = _mixed(hashes[where])
        for k in np.flatnonzero(lengths[begin:end] < SHINGLE):
            hashes[first[k]] = xxhash.xxh32_intdigest(lines[begin + k])
        scratch = np.empty_like(hashes)
        for k in range(n_hashes):
            np.multiply(hashes, factors[k], out=scratch)
            np.bitwise_xor(scratch, masks[k], out=scratch)
            out[begin:end, k] = np.minimum.reduceat(scratch, first)
        begin = end
    return out


def _band_hash(signature: np.ndarray, band: int) -> np.ndarray:
    h = np.full(len(signature), band + 1, np.uint64)
    for column in range(band * ROWS, (band + 1) * ROWS):
        h = (h ^ signature[:, column]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _entries(bits: int):
    """Packed band entries of each batch: of the lines in a band only the commonest, its head, goes to meet other batches.

    The other lines of the band, and lines that repeat in the batch, are settled and go anywhere, evenly.
    """
    def emit(frame: pd.DataFrame) -> pd.DataFrame:
        seen: dict[str, int] = {}
        ids, ties, numbers, weights, repeats = [], [], [], [], []
        done = None
        for doc, tie, text in sorted(zip(frame["id"], frame["tie"], frame["text"], strict=True)):
            if (doc, tie) == done:
                continue
            done = doc, tie
            for number, line in enumerate(text.lower().split("\n")):
                line = " ".join(line.split())
                if not line:
                    continue
                at = seen.setdefault(line, len(seen))
                if at == len(ids):
                    ids.append(doc)
                    ties.append(tie)
                    numbers.append(number)
                    weights.append(1)
                else:
                    weights[at] += 1
                    repeats.append((doc, tie, number))
        lines = list(seen)
        n = len(lines)
        signature = signatures(lines)
        mark = np.fromiter((xxhash.xxh64_intdigest(line, 3) for line in lines), np.uint64, n)
        weight = np.minimum(np.array(weights, np.int64), 65535).astype(np.uint16)
        place = [np.array(ids, np.int64), np.array(ties, np.int64).astype(np.uint32), np.array(numbers, np.uint32)]
        # Line by line, all bands of a line together, so that differences of places are small.
        h = np.stack([_band_hash(signature, band) for band in range(BANDS)], axis=1).ravel()
        head = _heads(h, np.repeat(weight, BANDS))
        marks = np.zeros((n, BANDS), np.uint8)
        marks[:, 0] = _FIRST_BAND
        marks = marks.ravel()
        followers = np.flatnonzero(head != np.arange(len(h)))
        marks[head[followers]] |= _FOLLOWED
        sent = np.flatnonzero(head == np.arange(len(h)))
        line = sent // BANDS
        met = pack(bucket_of(h[sent], bits), [
            _low(h[sent], bits), mark[line], marks[sent], weight[line], *(column[line] for column in place)], _DELTAS)

        again = np.array(repeats, np.int64).reshape(-1, 3)
        own, to = followers // BANDS, head[followers] // BANDS
        group = (bucket_of(h[followers], bits).astype(np.int64) << np.int64(32)) | _low(h[followers], bits).astype(np.int64)
        again = [again[:, 0], again[:, 1].astype(np.uint32), again[:, 2].astype(np.uint32)]
        settled = [
            np.r_[group, np.full(len(again[0]), _NO_GROUP, np.int64)],
            *(np.r_[column[own], more] for column, more in zip(place, again, strict=True)),
            *(np.r_[column[to], more] for column, more in zip(place, again, strict=True))]
        anywhere = (np.arange(len(settled[0])) % (1 << bits) + (1 << bits)).astype(np.int32)
        return pd.concat([met, pack(anywhere, settled, _SETTLED_DELTAS)], ignore_index=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            part = np.cumsum(frame["text"].str.len().to_numpy()) // _BATCH_CHARS
            for _, rows in frame.groupby(part, sort=False):
                yield emit(rows)

    return run


def _heads(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Of each entry the place of its band's head: the heaviest entry with its hash, the first of several."""
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    order = order[np.r_[False, same] | np.r_[same, False]] if len(order) else order
    order = order[np.lexsort((order, -weight[order].astype(np.int32), h[order]))]
    begins = np.r_[np.ones(min(1, len(order)), bool), h[order[1:]] != h[order[:-1]]]
    head = np.arange(len(h))
    head[order] = order[np.flatnonzero(begins)][np.cumsum(begins) - 1] if len(order) else order
    return head


def _low(h: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits of a hash behind those that name its bucket."""
    return ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


_PARTS = ("id", "tie", "line")
_MEMBERS = "line_group long, id long, tie long, line int, head_id long, head_tie long, head_line int"


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + part).alias(part) for part in _PARTS])


def _member_rows(group: np.ndarray, place: list[np.ndarray], head: list[np.ndarray]) -> pd.DataFrame:
    rows = {"line_group": pd.Series(group).astype("Int64").mask(group == _NO_GROUP)}
    for prefix, columns in (("", place), ("head_", head)):
        for part, column in zip(_PARTS, columns, strict=True):
            rows[prefix + part] = column.astype(np.int32 if part == "line" else np.int64)
    return pd.DataFrame(rows)


def _meet(bits: int):
    """Of one bucket: lines that have to go, without a group, and members of bands with their band's head.

    Lines of a band with one line hash, of 64 bits, are equal; the first stands for them all, and is the head of those that
    lines of their batch follow.  The head of a band is its commonest line.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] >= 1 << bits:
            group, *places = unpack(rows, _SETTLED_TYPES, _SETTLED_DELTAS)
            return _member_rows(group, places[:3], places[3:])
        h, mark, marks, weight, *place = unpack(rows, _TYPES, _DELTAS)
        order = np.argsort(h)
        same = h[order[1:]] == h[order[:-1]]
        order = order[np.r_[False, same] | np.r_[same, False] | (marks[order] & _FOLLOWED > 0)] if len(order) else order
        ids, ties, numbers = place
        order = order[np.lexsort([c[order] for c in (numbers, ties, ids, mark, h)])]
        new_band = np.r_[np.ones(min(1, len(order)), bool), h[order[1:]] != h[order[:-1]]]
        new_line = new_band.copy()
        new_line[1:] |= mark[order[1:]] != mark[order[:-1]]
        firsts, line_of = np.flatnonzero(new_line), np.cumsum(new_line) - 1
        leader = order[firsts][line_of] if len(order) else order
        later = np.logical_or.reduce([column[order] != column[leader] for column in place])
        gone = order[later & (marks[order] & _FIRST_BAND > 0)]
        linked = later & (marks[order] & _FOLLOWED > 0)
        equal, equal_to = order[linked], leader[linked]
        # From here on one entry per line.
        total = np.bincount(line_of, weight[order], len(firsts)) if len(order) else np.zeros(0)
        followed = np.bincount(line_of, marks[order] & _FOLLOWED > 0, len(firsts)) > 0 if len(order) else np.zeros(0, bool)
        line, band = order[firsts], (np.cumsum(new_band) - 1)[firsts]
        by_weight = np.lexsort((np.arange(len(line)), -total, band))
        starts = np.flatnonzero(np.r_[np.ones(min(1, len(line)), bool), band[1:] != band[:-1]])
        head = line[by_weight[starts]][band] if len(line) else line
        shared = (np.bincount(band, minlength=len(starts)) > 1)[band] | followed if len(line) else np.zeros(0, bool)
        at, to = np.r_[gone, line[shared], equal].astype(np.int64), np.r_[gone, head[shared], equal_to].astype(np.int64)
        group = (np.int64(rows["bucket"].iloc[0]) << np.int64(32)) | h[at].astype(np.int64)
        group[:len(gone)] = _NO_GROUP
        return _member_rows(group, [c[at] for c in place], [c[to] for c in place])

    return run


def _shingles(line: str) -> set[str]:
    return {line[k:k + SHINGLE] for k in range(max(1, len(line) - SHINGLE + 1))}


def _codes(line: str) -> np.ndarray:
    """The distinct shingles of a line as ascending numbers, 9 bits for each character; the line's characters have to fit."""
    points = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(points) - SHINGLE + 1
    codes = points[:n].copy()
    for j in range(1, SHINGLE):
        codes <<= np.uint64(_CHARACTER_BITS)
        codes |= points[j:j + n]
    codes.sort()
    return codes[np.r_[True, codes[1:] != codes[:-1]]]


class _Line:
    """A line and its set of shingles, in one of two exact forms, made when they are needed."""

    def __init__(self, text: str) -> None:
        self.text = text
        # Long lines of Latin scripts are compared as sorted numbers, all others as sets.
        self.is_long = len(text) > _LONG_LINE and ord(max(text)) < 1 << _CHARACTER_BITS

    @cached_property
    def shingles(self) -> set[str]:
        return _shingles(self.text)

    @cached_property
    def codes(self) -> np.ndarray:
        return _codes(self.text)

    def near(self, other: _Line, threshold: float) -> bool:
        """Whether the Jaccard similarity of the shingles of both lines reaches the threshold."""
        by_code = self.is_long and other.is_long
        a, b = (self.codes, other.codes) if by_code else (self.shingles, other.shingles)
        # Of n shingles at most n are shared, and at least as many as the longer line has are in one of both.
        if min(len(a), len(b)) / max(len(a), len(b)) < threshold:
            return False
        if by_code:
            both = np.concatenate([a, b])
            both.sort()
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
        else:
            shared = len(a & b)
        return shared / (len(a) + len(b) - shared) >= threshold


class _Lines(dict[str, _Line]):
    """Lines by text; of those seen last the shingles are kept."""

    def __missing__(self, text: str) -> _Line:
        if len(self) > _KNOWN_LINES:
            self.clear()
        line = self[text] = _Line(text)
        return line


def _similar(a: Column, b: Column, threshold: float) -> Column:
    """Whether the lines of a pair are similar; the shingles of a line that comes in many pairs are kept."""
    @F.pandas_udf("boolean")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        known = _Lines()
        return pd.Series(
            [x == y or known[x].near(known[y], threshold) for x, y in zip(left, right, strict=True)], dtype=bool)

    return run(a, b)


def _line_texts(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``place`` and ``text``, the normal line there."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, tie, text, numbers in zip(frame["id"], frame["tie"], frame["text"], frame["numbers"], strict=True):
                lines = text.split("\n")
                rows += [(doc, tie, n, normal(lines[n])) for n in numbers]
            yield pd.DataFrame(rows, columns=[*_PARTS, "text"])

    wanted = places.groupBy("place.id", "place.tie").agg(F.collect_set("place.line").alias("numbers"))
    found = texts.join(wanted, ["id", "tie"]).select("id", "tie", "text", "numbers")
    return found.mapInPandas(run, "id long, tie long, line int, text string").select(
        _place().alias("place"), "text").dropDuplicates(["place"])


def _near_heads(tried: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose lines are similar enough."""
    left = lines.select(F.col("place").alias("a"), F.col("text").alias("left"))
    right = lines.select(F.col("place").alias("b"), F.col("text").alias("right"))
    both = tried.join(left, "a").join(right, "b")
    return both.where(_similar(F.col("left"), F.col("right"), threshold)).select("a", "b")


def _small_forest(lines: list[_Line], root: list[int], threshold: float) -> list[tuple[int, int]]:
    links = []
    largest = max(root, key=root.count)
    for x in [x for x, tree in enumerate(root) if tree != largest]:
        for y in range(len(lines)):
            if root[y] != root[x] and lines[x].near(lines[y], threshold):
                links.append((x, y))
                joined = root[y]
                root = [root[x] if tree == joined else tree for tree in root]
    return links


def _forest(lines: list[_Line], root: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links between lines of one band whose components (``root``) are still apart: as many as connect them, no more.

    Lines outside the largest component are compared with those of all others: pair by pair in a small band, else by
    a tally of shared shingles over posting lists.
    """
    if len(lines) <= _SMALL_BAND:
        return _small_forest(lines, root.tolist(), threshold)
    if all(line.is_long for line in lines):
        sizes = np.fromiter((len(line.codes) for line in lines), np.int64, len(lines))
        _, code = np.unique(np.concatenate([line.codes for line in lines]), return_inverse=True)
    else:
        known: dict[str, int] = {}
        numbered = [[known.setdefault(shingle, len(known)) for shingle in line.shingles] for line in lines]
        sizes = np.fromiter(map(len, numbered), np.int64, len(numbered))
        code = np.fromiter(chain.from_iterable(numbered), np.int64, sizes.sum())
    own = np.split(code, np.cumsum(sizes)[:-1])
    members = np.repeat(np.arange(len(own)), sizes)[np.argsort(code, kind="stable")]
    ends = np.cumsum(np.bincount(code)).tolist()
    postings = [members[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    links, root = [], root.copy()
    for x in np.flatnonzero(root != np.bincount(root).argmax()).tolist():
        shared = np.bincount(np.concatenate([postings[code] for code in own[x].tolist()]), minlength=len(own))
        near = np.flatnonzero((shared / (sizes + sizes[x] - shared) >= threshold) & (root != root[x]))
        for tree, at in zip(*np.unique(root[near], return_index=True), strict=True):
            links.append((x, int(near[at])))
            root[root == tree] = root[x]
    return links


def _links_within(threshold: float):
    """The links of all bands of a partition that is sorted by band."""
    parts = [f"{side}_{part}" for side in "ab" for part in _PARTS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Lines()
        for part, begins, ends in groups_of(batches, ["line_group", "row", "column"]):
            places = part[list(_PARTS)].to_numpy()
            texts, roots = part["text"].tolist(), list(zip(*(part[f"root_{name}"] for name in _PARTS), strict=True))
            links = []
            for a, b in zip(begins, ends, strict=True):
                codes: dict[tuple, int] = {}
                root = np.array([codes.setdefault(r, len(codes)) for r in roots[a:b]])
                if len(codes) > 1:
                    links += [(a + x, a + y) for x, y in _forest([known[text] for text in texts[a:b]], root, threshold)]
            at = np.array(links, np.int64).reshape(-1, 2)
            yield pd.DataFrame(np.hstack([places[at[:, 0]], places[at[:, 1]]]), columns=parts)

    return run


def _links_in_bands(apart: DataFrame, lines: DataFrame, work: WorkArea, threshold: float, block: int = 2048) -> DataFrame:
    """Links (a, b) in bands whose members (line_group, place, root) are in several components.

    A band of more than ``block`` lines is dealt into pairs of blocks, which go to different tasks.
    """
    # Bands with the same members, of which there are many, are one.
    bands = apart.groupBy("line_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("place").cast("decimal(38,0)")).alias("sum"),
        F.sum(F.xxhash64(F.lit(1), "place").cast("decimal(38,0)")).alias("sum2"))
    bands = bands.groupBy("n", "sum", "sum2").agg(F.min("line_group").alias("line_group"))
    bands = work.table(bands.select("line_group", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "sizes")
    dealt = apart.join(bands, "line_group").withColumn(
        "mine", F.pmod(F.xxhash64("place"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"row": F.least("mine", "other"), "column": F.greatest("mine", "other")})
    rows = dealt.join(lines, "place").select(
        "line_group", "row", "column", "place.*", *[F.col(f"root.{part}").alias(f"root_{part}") for part in _PARTS], "text")
    band = ["line_group", "row", "column"]
    found = rows.repartition(*band).sortWithinPartitions(*band).mapInPandas(
        _links_within(threshold), ", ".join(f"{side}_id long, {side}_tie long, {side}_line int" for side in "ab"))
    return found.select(_place("a_").alias("a"), _place("b_").alias("b")).distinct()


def removed_lines(texts: DataFrame, work: WorkArea, threshold: float = 0.8) -> DataFrame:
    """``id, tie, gone``: the numbers of the lines that go, of each document (id, tie, text) that loses any."""
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    n = BANDS * (texts.agg(F.sum(n_lines.cast("long"))).first()[0] or 0)
    bits = min(30, bucket_bits(texts.sparkSession, n, _BUCKET_ENTRIES))
    met = work.table(
        texts.mapInPandas(_entries(bits), SCHEMA).groupBy("bucket").applyInPandas(_meet(bits), _MEMBERS), "bands")
    members = met.where("line_group IS NOT NULL").select(
        "line_group", _place().alias("place"), _place("head_").alias("head"))
    tried = work.table(
        members.where("place <> head").select(F.col("place").alias("a"), F.col("head").alias("b")).distinct(), "tried")
    lines = work.table(_line_texts(
        texts, tried.select(F.col("a").alias("place")).union(tried.select("b")).distinct()), "lines")
    links = work.table(_near_heads(tried, lines, threshold), "links")
    roots = connected_components(links, work)
    rooted = members.join(roots.withColumnRenamed("node", "place"), "place", "left").select(
        "line_group", "place", F.coalesce("root", "place").alias("root"))
    # A band of a head and one other line has been settled above.
    trees = F.xxhash64("root")
    apart = rooted.groupBy("line_group").agg(
        F.min(trees).alias("low"), F.max(trees).alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low <> high AND n > 2").select("line_group")
    apart = work.table(rooted.join(apart, "line_group", "left_semi"), "apart")
    more = work.table(_links_in_bands(apart, lines, work, threshold), "more_links")
    # Later links join components as wholes, so only the roots they touch are searched again.
    whole = lambda side: F.coalesce(f"{side}_root", side).alias(side)
    for side in "ab":
        more = more.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    joined = connected_components(more.select(whole("a"), whole("b")), work).select(
        F.col("node").alias("root"), F.col("root").alias("new"))
    alone = joined.join(roots, "root", "left_anti").select(F.col("root").alias("node"), F.col("new").alias("root"))
    roots = roots.join(joined, "root", "left").select("node", F.coalesce("new", "root").alias("root")).union(alone)
    gone = met.where("line_group IS NULL").select(_place().alias("place")).union(
        roots.where("node <> root").select(F.col("node").alias("place")))
    return work.table(
        gone.groupBy("place.id", "place.tie").agg(F.sort_array(F.collect_set("place.line")).alias("gone")), "gone")


def remove_lines(
    docs: DataFrame, columns: list[str] | None = None, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = 0.8,
) -> DataFrame:
    """``columns`` of each row of ``docs`` (all by default) with the text that is left, ``n_lines`` and ``gone``.

    ``n_lines`` counts the lines with a visible character, one that is no Unicode white space; ``gone`` lists the numbers of the removed ones, from 0.
    The other lines are joined again as they were.  Rows that agree in id and text are one document and
    lose the same lines.  A text may end up empty; its row stays.  Null texts stay null.  Ids are
    integers.  Columns named like new ones are replaced.  An empty table gives an empty result.
    """
    work = WorkArea(docs.sparkSession, "line-dedup")
    columns = [c for c in columns or docs.columns if c not in ("n_lines", "gone")]
    text = filled(F.col(text_column))
    document = {
        "__id": F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)),
        "__tie": F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)),
    }
    texts = docs.select(document["__id"].alias("id"), document["__tie"].alias("tie"), text.alias("text"))
    gone = removed_lines(texts, work, threshold).select(
        F.col("id").alias("__id"), F.col("tie").alias("__tie"), F.col("gone").alias("__gone"))
    lines = F.split(F.col("__text"), "\n")
    rows = docs.select(*columns, F.col(text_column).alias("__text"), *[c.alias(name) for name, c in document.items()])
    rows = rows.join(gone, ["__id", "__tie"], "left")
    left = F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(F.array_join(
        F.filter(lines, lambda line, at: ~F.array_contains("__gone", at)), "\n"))
    return rows.withColumns({
        "__left": left,
        "n_lines": F.size(F.filter(F.split(filled(F.col("__text")), "\n"), lambda line: line.rlike(VISIBLE))).cast("long"),
        "gone": F.coalesce("__gone", F.array().cast("array<int>")),
    }).select(*[F.col("__left").alias(c) if c == text_column else c for c in columns], "n_lines", "gone")
