"""Words and rolling hashes of whole Arrow text columns, computed on NumPy arrays inside a task.

All functions work on one flat byte buffer per slice of a batch, so nothing runs once per word in Python. A slice is cut
at document borders and holds some megabytes; a single longer document is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

SPACES = bytes([0x20, *range(0x09, 0x0E)])
"""Bytes that part words of the pattern ``[^\\x20\\x09-\\x0D]+``."""

NON_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
"""Bytes that part words of the pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (after lower-casing)."""


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
KEPT_POWERS = 4 << 20


def powers(n: int, which: str) -> np.ndarray:
    """BASE**i ("up") or BASE**-i ("down") for i < n; kept for the next slice, but not for a very long one."""
    have = _powers[which]
    if len(have) < n:
        step = np.full(max(n, 1 << 20), BASE if which == "up" else INVERSE, np.uint64)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if n <= KEPT_POWERS:
            _powers[which] = have
    return have[:n]


def release() -> None:
    """Give freed memory back to the system. Workers outlive their tasks, and what they hold on to is missing elsewhere.

    The kept powers go too: they are made again in a few milliseconds.
    """
    _powers.update(up=np.ones(1, np.uint64), down=np.ones(1, np.uint64))
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # no such function outside glibc


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL becomes an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``limit`` bytes; every document is in exactly one run."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of every word. Words end at separators and at the end of their document."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    mask = inside[data]
    edges = np.zeros(len(data) + 1, np.int8)
    edges[:-1] += mask
    edges[1:] -= mask
    first = edges == 1
    last = edges == -1
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    joined = borders[mask[borders - 1] & mask[borders]]
    first[joined] = True
    last[joined] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hashes`` turns two of them into the hash of the bytes between."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * powers(len(data), "up"), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; equal spans have equal hashes wherever they stand."""
    raw = (sums[ends] - sums[starts]) * powers(len(sums), "down")[starts]
    return mixed(raw + (ends - starts).astype(np.uint64))


def windows(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words. The caller drops the runs that cross documents."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * BASE + word_hash[i : i + n]
    return mixed(total)
