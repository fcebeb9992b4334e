"""Jaccard join of word n-gram sets with token-combination prefixes.

1. Slices of the corpus send their shingle hashes to hash buckets, which tell how many sets have each (``exchange``).
   A shingle of one set alone can link nothing, so only repeated shingles come back.
2. Order shingles by class: of one set, rare, frequent; then by hash. Two sets with Jaccard >= 0.8 differ in few shingles, so
   - if the first n - ceil(0.8 n) + 1 shingles of both hold only rare ones, they share one of these: single shingles are
     indexed;
   - if both prefixes reach into the frequent class and share no rare shingle, all they share is frequent. The prefix is
     extended to 0.4 n - 2 u + 2 frequent shingles (u: rarer ones): differences break at most 0.4 n - 2 u of the
     adjacent pairs in it, so one adjacent pair is the same in both. Frequent shingles are indexed in such pairs.
3. Every set is verified with the one it shares most entries with, of the least sets of its entries; then entries whose
   sets still lie in several components are verified in blocks of bounded size (``linking``). Overlap needs the repeated
   shingles alone. A bitmap of a set's shingles bounds the overlap from above, so most pairs need not be counted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractweave.llm import exchange, linking, packed
from tractweave.llm.shingles import document_sets, set_names
from tractweave.operators.scale import drop_stage, stage


@dataclass(frozen=True)
class JoinConfig:
    shingle: int = 5
    frequent: int = 64
    """A shingle that more sets have is of the frequent class. The result does not depend on it."""
    slice_bytes: int = 2 << 20
    block_sets: int = linking.BLOCK_SETS
    """Sets that are verified in one block. Larger groups are cut into blocks, and each pair of blocks is a task."""


SLICE_DOCS = 60_000
"""Below 2**16, so that slice and set make one number."""



def _packet(kind: pa.DataType) -> pa.Schema:
    return pa.schema(
        [
            ("to", pa.int64()),  # bucket, or below 0 for what a slice keeps for itself
            ("slice", pa.int64()),
            ("hashes", pa.binary()),
            ("owners", pa.binary()),
            ("shared", pa.binary()),
            ("counts", pa.binary()),
            ("ids", pa.list_(kind)),
            ("names", pa.list_(pa.int64())),
            ("sizes", pa.binary()),
            ("keys", pa.binary()),
        ]
    )


_PACKET_SQL = "to long, slice long, hashes binary, owners binary, shared binary, counts binary, ids array<{}>, names array<long>, sizes binary, keys binary"
_SET_SQL = "sid long, docs array<struct<id:{},name:long>>, n long, k1 long, k2 long, shingles binary, repeated long, bitmap binary, buckets array<long>"


def _packets(ids: pa.Array, names: pa.Array, raw: np.ndarray, offsets: np.ndarray, number: int, bits: int, config: JoinConfig) -> pa.RecordBatch:
    n = len(offsets) - 1
    owner, hashed = document_sets(raw, offsets, config.shingle)
    hashed = exchange.folded(hashed, bits)
    sizes, keys = set_names(owner, hashed, n)
    # copies inside the slice are one set; empty documents stay by themselves
    _, first, group = np.unique(np.column_stack([keys, sizes.astype(np.uint64)]), axis=0, return_index=True, return_inverse=True)
    set_of = first[group.reshape(-1)]
    set_of[sizes == 0] = np.flatnonzero(sizes == 0)
    sets = np.unique(set_of)
    number_of = np.zeros(n, np.int64)
    number_of[sets] = np.arange(len(sets))
    kept = set_of[owner] == owner
    owner, hashed = number_of[owner[kept]], hashed[kept]
    order = np.argsort(hashed, kind="stable")
    owner, hashed = owner[order], hashed[order]
    fresh = np.concatenate([[True], hashed[1:] != hashed[:-1]]) if len(hashed) else np.zeros(0, bool)
    run = np.cumsum(fresh) - 1
    many = np.bincount(run) if len(run) else np.zeros(0, np.int64)
    single = many[run] == 1 if len(run) else np.zeros(0, bool)
    alone, alone_owner = hashed[single], owner[single]
    shared, shared_count = hashed[fresh][many > 1], many[many > 1]
    schema = _packet(ids.type)
    rows = {name: [] for name in schema.names}

    def add(**values):
        for name in rows:
            rows[name].append(values.get(name))

    parts = {b: [(x, y), (0, 0)] for b, x, y in exchange.bucket_runs(alone, bits)}
    for b, x, y in exchange.bucket_runs(shared, bits):
        parts.setdefault(b, [(0, 0), (0, 0)])[1] = (x, y)
    for b, ((x, y), (p, q)) in parts.items():
        by_owner = np.argsort(alone_owner[x:y], kind="stable")  # the owners then need a count each only
        add(
            to=b,
            slice=number,
            hashes=exchange.pack(alone[x:y][by_owner]),
            owners=exchange.pack_counts(np.bincount(alone_owner[x:y], minlength=len(sets))),
            shared=exchange.pack(shared[p:q]),
            counts=shared_count[p:q].astype(np.uint32).tobytes(),
        )
    members = pa.array(np.argsort(number_of[set_of], kind="stable"))
    add(
        to=-1 - number,
        slice=number,
        hashes=hashed[~single].tobytes(),
        owners=owner[~single].astype(np.uint16).tobytes(),
        counts=np.bincount(number_of[set_of], minlength=len(sets)).astype(np.uint32).tobytes(),
        ids=ids.take(members).to_pylist(),
        names=names.take(members).to_pylist(),
        sizes=sizes[sets].astype(np.uint32).tobytes(),
        keys=keys[sets].tobytes(),
    )
    return pa.RecordBatch.from_pydict(rows, schema)


def _merge_bucket(packets: pa.Table, bits: int, frequent: int) -> pa.Table:
    """Count the sets of every hash of a bucket and send the repeated ones back, with their class."""
    to = packets["to"][0].as_py()
    if to < 0:
        return packets
    top = np.uint64(to) << np.uint64(64 - bits)
    alone = [exchange.unpack(x) | top for x in packets["hashes"].to_pylist()]
    shared = [exchange.unpack(x) | top for x in packets["shared"].to_pylist()]
    counts = [np.frombuffer(x, np.uint32) for x in packets["counts"].to_pylist()]
    every = np.concatenate([*alone, *shared])
    weight = np.concatenate([np.ones(sum(map(len, alone)), np.int64), *counts])
    order = np.argsort(every, kind="stable")
    found, first = np.unique(every[order], return_index=True)
    sets = np.add.reduceat(weight[order], first)
    rows = {name: [] for name in packets.column_names}
    for number, a, s, owners in zip(packets["slice"].to_pylist(), alone, shared, packets["owners"].to_pylist(), strict=True):
        in_sets = sets[np.searchsorted(found, a)]
        again = in_sets > 1
        per_owner = exchange.unpack_counts(owners)
        owner = np.repeat(np.arange(len(per_owner)), per_owner)
        if not again.any() and not len(s):
            continue
        for name in rows:
            rows[name].append(None)
        rows["to"][-1], rows["slice"][-1] = to, number
        rows["hashes"][-1] = exchange.pack(a[again])
        rows["owners"][-1] = (owner[again].astype(np.uint16)).tobytes()
        rows["sizes"][-1] = (in_sets[again] > frequent).astype(np.uint8).tobytes()
        rows["shared"][-1] = exchange.pack(s)
        rows["counts"][-1] = (sets[np.searchsorted(found, s)] > frequent).astype(np.uint8).tobytes()
    return pa.Table.from_pydict(rows, packets.schema)


def prefix_entries(n: int, tokens: np.ndarray, common: np.ndarray) -> np.ndarray | None:
    """Index entries of a set of ``n`` shingles, of which ``tokens`` are repeated and ``common`` marks the frequent ones.

    None if the prefix holds only shingles that no other set has.
    """
    alone = n - len(tokens)
    spare = n - (4 * n + 4) // 5 + 1 - alone  # prefix left for repeated shingles
    if spare <= 0:
        return None
    rare, frequent = np.sort(tokens[~common]), np.sort(tokens[common])
    entries = packed.mixed(rare[:spare] + np.uint64(1))
    if len(rare) < spare:
        reach = frequent[: (2 * n) // 5 - 2 * (alone + len(rare)) + 2]
        entries = np.concatenate([entries, packed.mixed(packed.mixed(reach[:-1]) * packed.BASE + reach[1:])])
    return entries


WORDS = 16
"""Words of a bitmap, 64 bits each."""


def parity_bitmap(tokens: np.ndarray) -> np.ndarray:
    """Bits that an odd number of ``tokens`` fall on. Two bitmaps differ in no more bits than their sets in tokens."""
    spread = packed.mixed(tokens)
    odd = np.bincount((spread % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def may_overlap(n: np.ndarray, repeated: np.ndarray, bits: np.ndarray, m: np.ndarray, also: np.ndarray, other: np.ndarray) -> np.ndarray:
    """False where two sets, of sizes ``n`` and ``m``, cannot be linked: what differs in the bitmaps is not shared."""
    differ = np.bitwise_count(bits ^ other).sum(axis=-1).astype(np.int64)
    return 9 * (repeated + also - differ) >= 8 * (n + m)


def _may_link(group: pa.Table) -> np.ndarray:
    """Pairs of a block pair's sets that may be linked and are not of one component."""
    root, n, own, repeated = (group[c].to_numpy() for c in ("root", "n", "own", "repeated"))
    bits = np.frombuffer(b"".join(group["bitmap"].to_pylist()), np.uint64).reshape(len(group), WORDS)
    within = group["x"][0] == group["y"][0]
    found = np.zeros((len(group), len(group)), bool)
    for a in range(0, len(group), 64):
        rows = slice(a, a + 64)
        pair = root[rows, None] != root
        if not within:
            pair &= own[rows, None] != own
        if pair.any():
            pair &= may_overlap(n[rows, None], repeated[rows, None], bits[rows, None], n, repeated, bits)
            found[rows] = pair
    return found


def likely_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Stored ``(a, b)``: the pairs that the bitmaps allow."""

    def compare(batches):
        for batch in batches:
            (n, repeated, bits), (m, also, other) = (
                (
                    batch.column(f"n_{side}").to_numpy(),
                    batch.column(f"x_{side}").field("repeated").to_numpy(),
                    np.frombuffer(b"".join(batch.column(f"x_{side}").field("bitmap").to_pylist()), np.uint64).reshape(-1, WORDS),
                )
                for side in "ab"
            )
            yield batch.select(["a", "b"]).filter(pa.array(may_overlap(n, repeated, bits, m, also, other)))

    both = linking.both_sides(pairs, sets.withColumn("x", F.struct("repeated", "bitmap")), "x")
    return stage(both.select("a", "b", "n_a", "n_b", "x_a", "x_b").mapInArrow(compare, "a long, b long"), "likely-pairs")


def _assemble(packets: pa.Table, bits: int) -> pa.Table:
    """All sets of a slice with their repeated shingles and index entries."""
    own = packets.filter(pc.less(packets["to"], 0)).to_pylist()[0]
    replies = packets.filter(pc.greater_equal(packets["to"], 0)).to_pylist()
    sizes = np.frombuffer(own["sizes"], np.uint32).astype(np.int64)
    keys = np.frombuffer(own["keys"], np.int64).reshape(-1, 2)
    members = np.frombuffer(own["counts"], np.uint32)
    top = [np.uint64(r["to"]) << np.uint64(64 - bits) for r in replies]
    tokens = [exchange.unpack(r["hashes"]) | t for r, t in zip(replies, top, strict=True)]
    owners = [np.frombuffer(r["owners"], np.uint16) for r in replies]
    common = [np.frombuffer(r["sizes"], np.uint8) for r in replies]
    local = np.frombuffer(own["hashes"], np.uint64)
    if len(local):
        shared = np.concatenate([exchange.unpack(r["shared"]) | t for r, t in zip(replies, top, strict=True)])
        classes = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in replies])
        order = np.argsort(shared)
        tokens.append(local)
        owners.append(np.frombuffer(own["owners"], np.uint16))
        common.append(classes[order][np.searchsorted(shared[order], local)])
    token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    often = np.concatenate(common).astype(bool) if common else np.zeros(0, bool)
    order = np.argsort(owner, kind="stable")
    token, owner, often = token[order], owner[order], often[order]
    at = np.searchsorted(owner, np.arange(len(sizes) + 1))
    last = np.cumsum(members)
    rows = {"sid": [], "docs": [], "n": [], "k1": [], "k2": [], "shingles": [], "repeated": [], "bitmap": [], "buckets": []}
    docs = [{"id": i, "name": t} for i, t in zip(own["ids"], own["names"], strict=True)]
    for s, n in enumerate(sizes.tolist()):
        mine = token[at[s] : at[s + 1]]
        entries = prefix_entries(n, mine, often[at[s] : at[s + 1]]) if n else None
        rows["sid"].append((own["slice"] << 16) + s)
        rows["docs"].append(docs[last[s] - members[s] : last[s]])
        rows["n"].append(n)
        rows["k1"].append(keys[s, 0])
        rows["k2"].append(keys[s, 1])
        rows["shingles"].append(None if entries is None else np.sort(mine).tobytes())
        rows["repeated"].append(len(mine))
        rows["bitmap"].append(None if entries is None else parity_bitmap(mine).tobytes())
        rows["buckets"].append(None if entries is None else np.unique(entries).view(np.int64))
    document = pa.struct([("id", packets.schema.field("ids").type.value_type), ("name", pa.int64())])
    types = [pa.int64(), pa.list_(document), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], list(rows))


def ngram_sets(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """Stored table of all distinct sets of every slice: ids of its documents, size, name, and for those that may be
    linked the repeated shingles and index entries."""
    bits = exchange.bucket_bits(docs, 6.0)
    kind = docs.schema["doc_id"].dataType.simpleString()
    packet = _PACKET_SQL.format(kind)

    def packets(batches):
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            raw, offsets = packed.buffers(batch.column("text"))
            for i, j in packed.slices(offsets, config.slice_bytes):
                for k in range(i, j, SLICE_DOCS):
                    end = min(j, k + SLICE_DOCS)
                    ids, names = (batch.column(c).slice(k, end - k) for c in ("doc_id", "name"))
                    yield _packets(ids, names, raw[offsets[k] : offsets[end]], offsets[k : end + 1] - offsets[k], number, bits, config)
                    number += 1
        packed.release()

    def merge(table: pa.Table) -> pa.Table:
        out = _merge_bucket(table, bits, config.frequent)
        packed.release()
        return out

    def assemble(table: pa.Table) -> pa.Table:
        out = _assemble(table, bits)
        packed.release()
        return out

    sent = docs.select("doc_id", "text").withColumn("name", F.xxhash64("text")).mapInArrow(packets, packet)
    replies = stage(sent.groupBy("to").applyInArrow(merge, packet), "shingle-replies")
    sets = stage(replies.groupBy("slice").applyInArrow(assemble, _SET_SQL.format(kind)), "shingle-sets")
    drop_stage(docs.sparkSession, replies)
    return sets


def set_roots(sets: DataFrame, names: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """``node`` and ``root``, both ``sid``, for every distinct set that is linked with another."""
    indexed = sets.filter("buckets IS NOT NULL").join(names.select("sid"), "sid", "left_semi")
    indexed = stage(indexed.select("sid", "n", "repeated", "bitmap", "buckets"), "indexed-sets")
    members = linking.buckets(indexed)
    best = linking.least_pairs(members).groupBy("a").agg(F.max_by("b", "times").alias("b"))
    best = likely_pairs(stage(best, "best-pairs"), indexed)

    def full(wanted: DataFrame) -> DataFrame:
        return stage(sets.select("sid", "n", "shingles").join(wanted, "sid", "left_semi"), "full-sets")

    return linking.set_components(members, best, indexed, full, 80, _may_link, config.block_sets)


def _components(docs: DataFrame, config: JoinConfig) -> DataFrame:
    sets = ngram_sets(docs, config)
    names = linking.distinct_names(sets)
    return linking.document_components(sets, names, stage(set_roots(sets, names, config), "set-roots"))


def near_duplicate_components(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    A document's set: distinct ``shingle``-word runs of its lower-cased (A-Z) words; the whole sequence if it has fewer words;
    nothing for NULL and empty texts, which are linked with nothing. Documents are linked if their sets have a Jaccard
    similarity of 0.8 or more; ``component_id`` is the smallest id reachable, the document's own included. Rows that repeat
    an id are rows of their own; a NULL id is never the smallest unless all in the component are NULL. Ids may be of any type
    that can be ordered. Very long texts are read whole. Shingles are compared by 48 bits and those that number their bucket.
    Other columns are not looked at; an empty table gives an empty one.
    """
    return _components(docs, config).select(F.col("doc.id").alias("doc_id"), "n_shingles", "component_id")


def drop_near_duplicates(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """One row of each component stays: of those with the smallest id the one with the least text name, and of equal rows one.

    Rows with a NULL id and rows without words all stay. Columns stay as they are, whatever their names.
    """
    rows = _components(docs.filter("doc_id IS NOT NULL"), config).filter("n_shingles > 0 AND doc.id = component_id")
    texts = rows.groupBy("root", "component_id", "doc.name").agg(F.count("*").alias("times"))
    first = texts.groupBy("root", "component_id").agg(F.min("name").alias("name"), F.min_by("times", "name").alias("times"))
    key, name, times = (f"{c}_{uuid.uuid4().hex}" for c in ("key", "name", "times"))
    first = stage(first.select(F.col("component_id").alias(key), F.col("name").alias(name), F.col("times").alias(times)), "kept-rows")
    worded = F.regexp_like(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]"))
    same = (F.col("doc_id") == F.col(key)) & (F.xxhash64("text") == F.col(name))
    found = docs.filter(worded & F.col("doc_id").isNotNull()).join(first, same)
    single = found.filter(F.col(times) == 1).select(*docs.columns)
    several = found.filter(F.col(times) > 1).dropDuplicates([key, name]).select(*docs.columns)
    kept = single if first.filter(F.col(times) > 1).isEmpty() else single.unionByName(several)
    return kept.unionByName(docs.filter(~worded | F.col("doc_id").isNull()))
