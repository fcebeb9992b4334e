"""Sets of word n-grams of the documents of a slice, and how much sets overlap, on NumPy arrays inside a task."""

from __future__ import annotations

import numpy as np

from tractweave.llm import packed


def document_sets(raw: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, shingle hash) of a slice, ordered by document, then hash."""
    n = len(offsets) - 1
    data = packed.lowered(raw)
    starts, ends, doc = packed.word_spans(data, offsets, packed.SPACES)
    words = packed.span_hashes(packed.prefix_hashes(data), starts, ends)
    hashes, owners = [], []
    counts = np.bincount(doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    for size in range(1, shingle):
        few = np.flatnonzero(counts == size)
        if len(few):
            total = np.zeros(len(few), np.uint64)
            for i in range(size):
                total = total * packed.BASE + words[first[few] + i]
            hashes.append(packed.mixed(total + np.uint64(size)))
            owners.append(few)
    if len(words) >= shingle:
        inside = doc[: len(doc) - shingle + 1] == doc[shingle - 1 :]
        hashes.append(packed.windows(words, shingle)[inside])
        owners.append(doc[: len(doc) - shingle + 1][inside])
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashed, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    fresh = np.concatenate([[True], (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])])
    return owner[fresh], hashed[fresh]


def set_names(owner: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 128-bit name of every document's set; equal sets have equal names."""
    sizes = np.bincount(owner, minlength=n)
    keys = np.zeros((n, 2), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        keys[some, 0] = packed.mixed(np.add.reduceat(packed.mixed(hashed), starts))
        keys[some, 1] = packed.mixed(np.add.reduceat(packed.mixed(hashed ^ packed.BASE), starts))
    return sizes, keys


DENSE = 24


def overlaps(run: np.ndarray, owner: np.ndarray, m: int) -> np.ndarray:
    """Shingles that each two of ``m`` sets share; ``run`` numbers the shingles in order, ``owner`` has their sets.

    Shingles of many sets are columns of a 0/1 matrix that is multiplied with itself, those of few are counted pair by pair.
    """
    overlap = np.zeros((m, m), np.float32)
    if not len(run):
        return overlap
    sets = np.bincount(run)
    dense = sets[run] > DENSE
    column, row = np.unique(run[dense], return_inverse=True)[1], owner[dense]
    width = max(64, min(4096, (32 << 20) // (4 * m)))
    borders = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + width, width)) if len(column) else [0]
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        part = np.zeros((m, width), np.float32)
        part[row[a:b], column[a:b] % width] = 1
        overlap += part @ part.T
    sparse = owner[~dense]
    size = sets[run[~dense]]
    start = np.flatnonzero(np.concatenate([[True], run[~dense][1:] != run[~dense][:-1]])) if len(sparse) else np.zeros(0, np.int64)
    first = np.repeat(start, size[start])
    flat = overlap.reshape(-1)
    step = (4 << 20) // DENSE
    for a in range(0, len(sparse), step):  # every place against all places of its shingle
        times = size[a : a + step]
        other = np.repeat(first[a : a + step], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        cell, count = np.unique(np.repeat(sparse[a : a + step], times) * m + sparse[other], return_counts=True)
        flat[cell] += count
    return overlap
