"""Near duplicates by MinHash: universal hash minima, bands, checks of signatures and of whole sets, connected components.

1. Slices of the corpus turn documents into sets of word n-grams and sets into minima of many universal hashes. Groups of
   ``rows`` minima make a band value; the low byte of every minimum stays as signature. Equal sets become one.
2. Sets with a band value in common share a bucket. Each set is first held against the least set of its buckets: of those
   whose signature agrees often enough, the one that agrees most is confirmed on the full sets. These links give components.
3. Only buckets that still hold several components are compared further, in blocks of bounded size: signatures tell which
   sets may be linked with a set of another component, and these are compared as full sets. Pairs are never listed, and no
   bucket has a limit.
4. Components of all links (``components``).

Full sets are made anew from the text, for sets that have a candidate; the shingles of the others are never sent or stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractweave.llm import linking, packed
from tractweave.llm.shingles import document_sets, set_names
from tractweave.operators.scale import stage


@dataclass(frozen=True)
class MinHashConfig:
    shingle: int = 4
    percent: int = 80
    """Sets are linked if 100 * intersection >= percent * union."""
    bands: int = 32
    rows: int = 5
    """Two sets of similarity 0.8 miss all 32 bands of 5 once in 300,000 times."""
    agree: int = 102
    """Minima of 160 that a pair has to share to be confirmed. At similarity 0.8 it shares 128 on average, with a standard
    deviation of 5; fewer than 102 come once in millions of pairs."""
    seed: int = 13
    slice_bytes: int = 2 << 20
    block_sets: int = 512
    """Sets of a block; every two blocks of a larger bucket are compared in a task of their own."""


SLICE_DOCS = 60_000


def universal_hashes(config: MinHashConfig) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``(a x + b mod 2**64) >> 32``."""
    drawn = np.random.default_rng(config.seed).integers(0, 1 << 64, (2, config.bands * config.rows), np.uint64)
    return drawn[0] | np.uint64(1), drawn[1]


def minima(hashed: np.ndarray, starts: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Least value of every hash over each run of ``hashed``: ``(runs, hashes)``."""
    out = np.empty((len(starts), len(factors)), np.uint32)
    if len(starts):
        for i, (a, b) in enumerate(zip(factors, offsets, strict=True)):
            out[:, i] = np.minimum.reduceat(((hashed * a + b) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_values(least: np.ndarray, config: MinHashConfig) -> np.ndarray:
    """One value per set and band; the number of the band is part of it."""
    bands = least.reshape(len(least), config.bands, config.rows).astype(np.uint64)
    value = np.arange(1, config.bands + 1, dtype=np.uint64)[None, :].repeat(len(least), axis=0)
    for i in range(config.rows):
        value = packed.mixed(value * packed.BASE + bands[:, :, i])
    return value.view(np.int64)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


_SIGNED = ["sid", "docs", "n", "k1", "k2", "buckets", "signature"]


def _signed(ids: pa.Array, names: pa.Array, raw: np.ndarray, offsets: np.ndarray, first: int, config: MinHashConfig) -> pa.RecordBatch:
    """The distinct sets of a slice: documents (id and name of the text), size, 128-bit name, bands and signature."""
    n = len(offsets) - 1
    owner, hashed = document_sets(raw, offsets, config.shingle)
    sizes, keys = set_names(owner, hashed, n)
    _, at, group = np.unique(np.column_stack([keys, sizes.astype(np.uint64)]), axis=0, return_index=True, return_inverse=True)
    group = group.reshape(-1)
    members = np.argsort(group, kind="stable")
    borders = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=len(at)))])
    some = sizes[at] > 0
    mine = np.zeros(n, bool)
    mine[at] = True
    kept = hashed[mine[owner]]
    filled = np.flatnonzero(mine & (sizes > 0))
    starts = np.cumsum(sizes[filled]) - sizes[filled]
    least = minima(kept, starts, *universal_hashes(config))
    line = np.zeros(n, np.int64)
    line[filled] = np.arange(len(filled))
    least = least[line[at[some]]]
    ends = np.concatenate([[0], np.cumsum(some)])
    signature = np.empty(len(at), object)
    signature[:] = b""
    signature[some] = [x.tobytes() for x in (packed.mixed(least.astype(np.uint64)) & np.uint64(255)).astype(np.uint8)]
    members = pa.array(members)
    documents = pa.StructArray.from_arrays([ids.take(members), names.take(members)], ["id", "name"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(first + np.arange(len(at))),
            _lists(borders, documents),
            pa.array(sizes[at].astype(np.int64)),
            pa.array(keys[at, 0].view(np.int64)),
            pa.array(keys[at, 1].view(np.int64)),
            _lists(ends * config.bands, pa.array(band_values(least, config).reshape(-1))),
            pa.array(signature, pa.binary()),
        ],
        _SIGNED,
    )


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").withColumn("name", F.xxhash64("text"))


def signed_sets(docs: DataFrame, config: MinHashConfig) -> DataFrame:
    """Stored table of the distinct sets of every slice of the corpus."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            raw, offsets = packed.buffers(batch.column("text"))
            for i, j in packed.slices(offsets, config.slice_bytes):
                for k in range(i, j, SLICE_DOCS):
                    end = min(j, k + SLICE_DOCS)
                    ids, names = (batch.column(c).slice(k, end - k) for c in ("doc_id", "name"))
                    yield _signed(ids, names, raw[offsets[k] : offsets[end]], offsets[k : end + 1] - offsets[k], number, config)
                    number += end - k
        packed.release()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"sid long, docs array<struct<id:{kind},name:long>>, n long, k1 long, k2 long, buckets array<long>, signature binary"
    return stage(_named(docs).mapInArrow(sign, schema), "signed-sets")


def full_sets(docs: DataFrame, wanted: DataFrame, config: MinHashConfig) -> DataFrame:
    """Stored ``(sid, n, shingles)`` of the ``wanted`` sets ``(sid, docs)``, made from the text of their first document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = packed.buffers(batch.column("text"))
            for i, j in packed.slices(offsets, config.slice_bytes):
                owner, hashed = document_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], config.shingle)
                sizes = np.bincount(owner, minlength=j - i)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                shingles = pa.array([hashed[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("sid").slice(i, j - i), pa.array(sizes.astype(np.int64)), shingles], ["sid", "n", "shingles"])
        packed.release()

    home = wanted.select("sid", F.get("docs", F.lit(0)).alias("home"))
    same = F.col("doc_id").eqNullSafe(F.col("home.id")) & (F.col("name") == F.col("home.name"))
    texts = _named(docs).join(home, same).select("sid", "text")
    made = texts.mapInArrow(read, "sid long, n long, shingles binary")
    return stage(made.dropDuplicates(["sid"]), "full-sets")  # rows may repeat a document


def agreeing_pairs(pairs: DataFrame, sets: DataFrame, config: MinHashConfig) -> DataFrame:
    """Stored ``(a, b, agree)``: pairs whose sizes and signatures allow a link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = config.bands * config.rows
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, width) for c in ("x_a", "x_b"))
            same = (x == y).sum(axis=1)
            enough = pa.array(same >= config.agree)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same.astype(np.int64))], ["a", "b", "agree"]).filter(enough)

    both = linking.both_sides(pairs, sets, "signature").filter(linking.near_size(F.col("n_a"), F.col("n_b"), config.percent))
    return stage(both.select("a", "b", "x_a", "x_b").mapInArrow(compare, "a long, b long, agree long"), "agreeing-pairs")


def _may_link(group: pa.Table, config: MinHashConfig) -> np.ndarray:
    """Pairs of a block pair's sets that may be linked and are not of one component."""
    m = len(group)
    root, n, own = (group[c].to_numpy() for c in ("root", "n", "own"))
    signature = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(m, -1)
    within = group["x"][0] == group["y"][0]
    found = np.zeros((m, m), bool)
    for a in range(0, m, 64):
        rows = slice(a, a + 64)
        pair = (root[rows, None] != root) & (100 * np.minimum(n[rows, None], n) >= config.percent * np.maximum(n[rows, None], n))
        if not within:
            pair &= own[rows, None] != own
        if pair.any():
            pair &= (signature[rows, None] == signature).sum(axis=2) >= config.agree
            found[rows] = pair
    return found


def set_components(docs: DataFrame, sets: DataFrame, config: MinHashConfig) -> DataFrame:
    """``(node, root)`` of every set that is linked with another."""
    members = linking.buckets(sets)
    pairs = stage(linking.least_pairs(members).drop("times"), "bucket-pairs")
    agreeing = agreeing_pairs(pairs, sets, config)
    # a set of a larger bucket may have its partners among the others
    wanted = agreeing.select("a").union(agreeing.select("b")).union(members.filter("size > 2").select("sid")).distinct()
    full = full_sets(docs, sets.join(wanted.withColumnRenamed("a", "sid"), "sid", "left_semi"), config)
    best = stage(agreeing.groupBy("a").agg(F.max_by("b", "agree").alias("b")), "best-pairs")
    signed = sets.select("sid", "n", "signature")
    return linking.set_components(members, best, signed, lambda _: full, config.percent, lambda group: _may_link(group, config), config.block_sets)


def minhash_components(docs: DataFrame, config: MinHashConfig = MinHashConfig()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    A document's set: distinct ``shingle``-word runs of its lower-cased (A-Z) words; the whole sequence if it has fewer words;
    nothing for NULL and empty texts, which are linked with nothing. Documents whose sets have at least ``percent`` of their
    union in common are linked; ``component_id`` is the smallest id reachable, the document's own included, and ``kept`` is set
    where the two are the same. Rows that repeat an id are rows of their own; a NULL id is the smallest only if all in the component are
    NULL. Ids may be of any type that can be ordered. Very long texts are read whole. ``docs`` is read twice and has to be the
    same both times. Other columns are not looked at; an empty table gives an empty one.
    """
    signed = signed_sets(docs, config)
    names = linking.distinct_names(signed)
    columns = ["sid", "docs", "n", "buckets", "signature"]
    sets = stage(signed.select(*columns).join(names.select("sid"), "sid", "left_semi"), "distinct-sets")
    roots = stage(set_components(docs, sets, config), "set-roots")
    rows = linking.document_components(signed, names, roots)
    return rows.select(F.col("doc.id").alias("doc_id"), "n_shingles", "component_id", F.col("doc.id").eqNullSafe(F.col("component_id")).alias("kept"))
