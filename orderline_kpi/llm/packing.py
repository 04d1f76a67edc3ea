"""Columns of numbers packed into few rows, for shuffles of very many small entries.

A row holds all entries that one batch sends to one bucket.  Numbers are written as differences and
with equal bytes next to each other, so the compression of the shuffle removes what repeats.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

SCHEMA = "bucket int, entries int, packed binary"


def bucket_bits(spark: SparkSession, n: int, each: int) -> int:
    """Bits of a bucket's number: as many buckets as shuffle partitions, and more if one would get over ``each`` of ``n``."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(31, max(0, partitions - 1, -(-n // each) - 1).bit_length())


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each hash, by its highest bits; in two bytes where they do, which sort faster."""
    kind = np.int16 if bits < 16 else np.int32
    return (hashes >> np.uint64(64 - bits)).astype(kind) if bits else np.zeros(len(hashes), kind)


def pack(bucket: np.ndarray, columns: list[np.ndarray], deltas: list[bool]) -> pd.DataFrame:
    """One row for each bucket with the entries that go there, in their order."""
    order = np.argsort(bucket, kind="stable")
    sorted_bucket, columns = bucket[order], [column[order] for column in columns]
    changes = np.flatnonzero(sorted_bucket[1:] != sorted_bucket[:-1]) + 1
    begins, ends = (np.r_[0, changes], np.r_[changes, len(order)]) if len(order) else (changes, changes)
    rows = []
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        parts = []
        for column, delta in zip(columns, deltas, strict=True):
            part = column[a:b]
            if delta:
                part = np.diff(part, prepend=part.dtype.type(0))
            parts.append(np.ascontiguousarray(part).view(np.uint8).reshape(b - a, -1).T.tobytes())
        rows.append((int(sorted_bucket[a]), b - a, b"".join(parts)))
    return pd.DataFrame(rows, columns=["bucket", "entries", "packed"])


def unpack(rows: pd.DataFrame, dtypes: list[type], deltas: list[bool]) -> list[np.ndarray]:
    """The columns of all rows' entries, one after another."""
    found: list[list[np.ndarray]] = [[np.empty(0, kind)] for kind in dtypes]
    for n, packed in zip(rows["entries"], rows["packed"], strict=True):
        at = 0
        for column, kind, delta in zip(found, dtypes, deltas, strict=True):
            width = np.dtype(kind).itemsize
            raw = np.frombuffer(packed, np.uint8, n * width, at).reshape(width, n)
            part = np.ascontiguousarray(raw.T).view(kind).ravel()
            column.append(np.cumsum(part, dtype=kind) if delta else part)
            at += n * width
    return [np.concatenate(column) for column in found]
