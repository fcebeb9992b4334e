"""Which hashes stand in more than one place: packed exchange of 64-bit hashes between slices of a corpus and hash buckets.

A slice is some megabytes of documents, handled at once on NumPy arrays. It sends each distinct hash once, in one binary
value per bucket, so a hash that stands in most documents costs a bucket one entry a slice, and no task ever holds more
than a bucket or a slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRIES = 1_500_000
"""Hashes of a bucket on average."""


def bucket_bits(docs: DataFrame, bytes_per_hash: float) -> int:
    """Leading bits that number the buckets, from the size of all texts; never below those of the shuffle's partitions."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    want = max(size / bytes_per_hash / ENTRIES, 2.0 * width)
    return min(20, max(3, int(np.ceil(np.log2(want)))))


def bucket_runs(sorted_hashes: np.ndarray, bits: int):
    """(bucket, first, last) for each bucket that has hashes."""
    buckets = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(buckets) else []
    ends = [*at[1:], len(buckets)] if len(buckets) else []
    for a, b in zip(at, ends, strict=True):
        yield int(buckets[a]), int(a), int(b)


def pack(hashes: np.ndarray) -> bytes:
    """Six bytes a hash: the bucket has the leading bits, and the rest is cut to 48 bits more."""
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in the least bytes that hold the largest; the first byte tells how many."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if not len(counts) or counts.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + counts.astype(kind).tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def folded(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Hashes as they are compared: the leading ``bits``, then the last 48."""
    return (hashes >> np.uint64(64 - bits) << np.uint64(64 - bits)) | (hashes & np.uint64((1 << 48) - 1))


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
