"""A quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics are binned by the quantiles of the training rows.  Trees are grown level by level
from histograms of gradients over the bins, and kept as complete binary trees in three arrays, so
that a batch of documents walks down all trees at once in numpy.

Training is done on the driver on at most ``max_train_rows`` labelled rows, a documented bound; which
rows is decided by a hash of their ids.  Scoring reads each text once and shuffles nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orderline_kpi.llm.common import filled

STATISTICS = (
    "log_chars", "bytes_per_char", "lower", "upper", "digits", "space", "stops", "other_marks", "symbols", "exclaimed",
    "log_words", "word_length", "word_length_deviation", "distinct_words", "top_word", "capital_words", "short_words",
    "wordless", "distinct_pairs", "distinct_triples", "log_lines", "repeated_lines", "line_length", "compressed",
    "words_per_stop", "bars",
)
_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789",
    "space": b" \t\n\r\x0b\x0c", "stops": b".,;:?", "other_marks": b"\"'()[]{}-_/\\@+=~^`", "symbols": b"#*$%&<>",
    "exclaimed": b"!", "bars": b"|",
}
_MEMBERS = {name: np.frombuffer(members, np.uint8) for name, members in _CLASSES.items()}


def statistics(text: str) -> list[float]:
    """The ``STATISTICS`` of a text; shares are of bytes, words or lines; all 0 for an empty text."""
    raw = text.encode("utf-8")
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = {name: counts[members].sum() / len(raw) for name, members in _MEMBERS.items()}
    words = raw.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    distinct = set(words)
    codes = {word: k for k, word in enumerate(distinct)}
    ids = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(codes) + ids[1:]
    triples = np.unique(pairs, return_inverse=True)[1][:-1] * len(codes) + ids[2:] if len(ids) > 2 else pairs[:0]
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        np.log1p(len(text)), len(raw) / len(text), share["lower"], share["upper"], share["digits"], share["space"],
        share["stops"], share["other_marks"], share["symbols"], share["exclaimed"],
        np.log1p(len(words)), lengths.mean(), lengths.std(), len(distinct) / n,
        np.bincount(ids).max() / n if words else 0.0, sum(map(bytes.isupper, words)) / n, (lengths <= 3).mean(),
        float(not words), len(np.unique(pairs)) / max(1, len(pairs)), len(np.unique(triples)) / max(1, len(triples)),
        np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), len(raw) / max(1, len(lines)),
        len(zlib.compress(raw, 1)) / len(raw), n / (1 + counts[ord(".")]), share["bars"],
    ]


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: of each tree the features and limits of its inner nodes, and its leaves."""

    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        total = np.full(len(x), self.start)
        depth, rows = self.leaves.shape[1].bit_length() - 1, np.arange(len(x))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, features[at]] > limits[at])
            total += leaves[at - len(features)]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, n_trees: int = 100, depth: int = 4, rate: float = 0.1, n_bins: int = 64,
    ridge: float = 1.0, min_weight: float = 1.0,
) -> Trees:
    """Boosted trees for the logistic loss.  With one class only, or no rows, they are constant."""
    inner, n_features = 2 ** depth - 1, x.shape[1]
    features = np.zeros((n_trees, inner), np.int64)
    limits = np.full((n_trees, inner), np.inf)
    leaves = np.zeros((n_trees, inner + 1))
    mean = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(mean / (1 - mean)))
    if not len(y) or y.min() == y.max():
        return Trees(features[:0], limits[:0], leaves[:0], start)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1])) for f in range(n_features)]
    bins = np.stack([np.searchsorted(edge, x[:, f], side="left") for f, edge in enumerate(edges)], axis=1)
    flat = bins + n_bins * np.arange(n_features)
    margin = np.full(len(y), start)
    for tree in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            cell = ((at - first)[:, None] * (n_features * n_bins) + flat).ravel()
            shape = width, n_features, n_bins
            g, h = (
                np.bincount(cell, np.repeat(values, n_features), width * n_features * n_bins).reshape(shape).cumsum(2)
                for values in (slope, curve)
            )
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g ** 2 / (all_h + ridge)
            gain[(h < min_weight) | (all_h - h < min_weight)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for node, cut in enumerate(best.tolist()):
                feature, bin_ = divmod(cut, n_bins)
                if gain[node, feature, bin_] > 1e-9 and bin_ < len(edges[feature]):
                    features[tree, first + node], limits[tree, first + node] = feature, edges[feature][bin_]
            at = 2 * at + 1 + (x[np.arange(len(y)), features[tree, at]] > limits[tree, at])
        leaf = at - inner
        g, h = (np.bincount(leaf, values, inner + 1) for values in (slope, curve))
        leaves[tree] = -rate * g / (h + ridge)
        margin += leaves[tree, leaf]
    return Trees(features, limits, leaves, start)


def is_held_out(doc_id: Column) -> Column:
    """True for the third of the ids whose labels are not learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _with_statistics(docs: DataFrame, id_column: str, text_column: str, extra: str, result) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), filled(F.col(text_column)).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([statistics(text) for text in batch["text"]]).reshape(-1, len(STATISTICS))
            yield batch[["id"]].assign(**result(x))

    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, {extra}")


def train(
    docs: DataFrame, labels: DataFrame, label_column: str = "quality", max_train_rows: int = 20_000,
    id_column: str = "doc_id", text_column: str = "text",
) -> Trees:
    """Trees fitted to the labelled documents that are not held out, at most ``max_train_rows`` of them.

    Those with the smallest hash of their id are taken.  Rows without id or label count for nothing;
    of contradicting labels for an id the larger one counts.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).where(
        ~is_held_out(F.col(id_column))
    ).groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(max_train_rows)
    # At most max_train_rows ids are broadcast.
    chosen = docs.join(F.broadcast(known.select(F.col("id").alias(id_column))), id_column, "left_semi")
    numbers = _with_statistics(chosen, id_column, text_column, "x array<double>", lambda x: {"x": list(x)})
    rows = numbers.join(F.broadcast(known), "id").orderBy(F.xxhash64("id"), "id", "x").limit(max_train_rows).toPandas()
    x = np.array(rows["x"].tolist()).reshape(-1, len(STATISTICS))
    return fit_trees(x, rows["label"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id and ``score``, from 0 to 1.  Null texts count as empty ones."""
    return _with_statistics(
        docs, id_column, text_column, "score double", lambda x: {"score": trees.scores(x)}
    ).withColumnRenamed("id", id_column)
