"""Links between sets that share a bucket: the best pair of every set first, then what is left between components.

``sets`` has ``sid``, ``n`` (size of the whole set), ``buckets`` (what it is indexed under) and what ``may_link`` looks at; a full
set has ``sid``, ``n`` and ``shingles`` (sorted 64-bit values, at least those that another set has), and is fetched by ``full``
for the sets that need it.

1. Each set is held against the least set of its buckets, and the most likely of these pairs is confirmed. The links give
   components.
2. Only buckets that still hold several components are looked at further, in blocks of bounded size: ``may_link`` tells which
   sets of different components are worth counting. Such sets form groups, and groups are compared as full sets, in blocks
   again; so a full set is sent for its group, not for every bucket it lies in. Pairs are never listed, pairs inside a component
   are not asked for, and neither buckets nor groups have a limit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractweave.llm import packed
from tractweave.llm.components import connected_components, contract
from tractweave.llm.shingles import overlaps
from tractweave.operators.scale import hot_keys, join_in_parts, shuffle_width, stage

BLOCK_SETS = 512
"""Sets of a block; every two blocks of a larger bucket are compared in a task of their own."""


def buckets(sets: DataFrame) -> DataFrame:
    """Stored ``(v, sid, least, size)``: members of every bucket of two sets and more, with its least set and size."""
    rows = sets.select("sid", F.explode("buckets").alias("v"))
    sizes = rows.groupBy("v").agg(F.min("sid").alias("least"), F.count("*").alias("size")).filter("size > 1")
    hot = hot_keys(sizes, ["v"], rows.count(), "size")
    return stage(join_in_parts(rows, sizes, ["v"], hot, F.col("sid")), "buckets")


def both_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """Pairs ``(a, b)`` with size and ``column`` of both; a set that is ``b`` of very many pairs is sent in parts."""
    hot = hot_keys(pairs.groupBy("b").agg(F.count("*").alias("n_rows")), ["b"], pairs.count())

    def side(name: str) -> DataFrame:
        return sets.select(F.col("sid").alias(name), F.col("n").alias(f"n_{name}"), F.col(column).alias(f"x_{name}"))

    return join_in_parts(pairs.join(side("a"), "a"), side("b"), ["b"], hot, F.col("a"))


def near_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def linked_pairs(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Stored ``(a, b)``: the pairs whose full sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            for x, y, size in zip(batch.column("x_a"), batch.column("x_b"), sizes.tolist(), strict=True):
                shared = len(np.intersect1d(*(np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y)), assume_unique=True))
                linked.append(100 * shared >= percent * (size - shared))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
        packed.release()

    rows = both_sides(pairs, full, "shingles").filter(near_size(F.col("n_a"), F.col("n_b"), percent))
    return stage(rows.select("a", "b", "n_a", "n_b", "x_a", "x_b").mapInArrow(confirm, "a long, b long"), "links")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` of sorted batches; a run may stretch over several."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = np.column_stack([batch.column(k).to_numpy() for k in keys])
        borders = np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1
        if last is not None and (columns[0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for border in borders.tolist():
            held.append(batch.slice(at, border - at))
            yield pa.Table.from_batches(held)
            held, at = [], border
        held.append(batch.slice(at))
        last = columns[-1]
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(members: DataFrame, block_sets: int) -> DataFrame:
    """Members ``(v, sid, root, ...)`` of every bucket in blocks, once for each two blocks ``(x, y)``; rows of a group come together."""
    sizes = members.groupBy("v").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    hot = hot_keys(sizes, ["v"], members.count(), "size")
    blocks = F.when(F.col("size") <= 2 * block_sets, 1).otherwise(F.ceil(F.col("size") / block_sets)).cast("int")
    rows = join_in_parts(members, sizes.select("v", blocks.alias("blocks")), ["v"], hot, F.col("sid"))
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        rows.withColumn("own", own)
        .withColumn("other", other)
        .withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})
        .drop("blocks", "other")
        .repartition(shuffle_width(members.sparkSession), "v", "x", "y")
        .sortWithinPartitions("v", "x", "y")
    )


def flooded(links: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row that it reaches."""
    m = len(links)
    root = np.full(m, -1)
    for s in range(m):
        if root[s] < 0:
            reached = edge = np.arange(m) == s
            while edge.any():
                edge = links[edge].any(axis=0) & ~reached
                reached = reached | edge
            root[reached] = s
    return root


def _block_links(group: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block pair's sets, (set, first set reached) over any number of links between full sets."""
    ids, first = np.unique(group["sid"].to_numpy(), return_index=True)
    shingles = [np.frombuffer(group["shingles"][i].as_buffer(), np.uint64) for i in first.tolist()]
    m, sizes = len(ids), group["n"].to_numpy()[first]
    every = np.concatenate(shingles)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], np.repeat(np.arange(m), [len(s) for s in shingles])[order]
    run = np.cumsum(np.concatenate([np.ones(min(1, len(every)), bool), every[1:] != every[:-1]])) - 1
    several = np.bincount(run, minlength=1)[run] > 1
    shared = overlaps(np.unique(run[several], return_inverse=True)[1], owner[several], m)
    links = 100 * shared >= percent * (sizes[:, None] + sizes - shared)
    return ids, ids[flooded(links)]


def links_between_components(
    members: DataFrame,
    roots: DataFrame,
    sets: DataFrame,
    full: Callable[[DataFrame], DataFrame],
    percent: int,
    may_link: Callable[[pa.Table], np.ndarray],
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """Links that connect sets of one bucket but different components, all of them up to connectedness.

    ``may_link`` tells from what ``sets`` has which sets of a block may be linked, though of different components, as a matrix.
    It must not leave out a link.
    """

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["v", "x", "y"]):
            ids, root = group["sid"].to_numpy(), flooded(may_link(group))
            other = root != np.arange(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids[other]), pa.array(ids[root[other]])], ["a", "b"])

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["v", "x", "y"]):
            a, b = _block_links(group, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from contract(sifted(batches))
        packed.release()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from contract(confirmed(batches))
        packed.release()

    rooted = members.select("v", "sid").join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "sid"))
    mixed = rooted.groupBy("v").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("v")
    rows = stage(rooted.join(mixed, "v", "left_semi"), "open-buckets")
    seen = in_blocks(rows.join(sets.drop("buckets"), "sid"), block_sets)
    worth = connected_components(seen.mapInArrow(sift, "a long, b long"))
    rows = worth.select(F.col("node").alias("sid"), F.col("root").alias("v")).join(roots.withColumnRenamed("node", "sid"), "sid", "left")
    rows = stage(rows.withColumn("root", F.coalesce("root", "sid")), "open-sets")
    left = in_blocks(rows.join(full(rows.select("sid")).select("sid", "n", "shingles"), "sid"), block_sets)
    return stage(left.mapInArrow(confirm, "a long, b long"), "links")


def least_pairs(members: DataFrame) -> DataFrame:
    """``(a, b, times)``: every set with the least sets of its buckets, and how many buckets the two share so."""
    return members.filter("sid <> least").groupBy(F.col("sid").alias("a"), F.col("least").alias("b")).agg(F.count("*").alias("times"))


def set_components(
    members: DataFrame,
    best: DataFrame,
    sets: DataFrame,
    full: Callable[[DataFrame], DataFrame],
    percent: int,
    may_link: Callable[[pa.Table], np.ndarray],
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """``(node, root)`` of every set that is linked with another; ``best`` are the pairs to confirm first."""
    wanted = best.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    links = linked_pairs(best, full(wanted), percent)
    roots = stage(connected_components(links), "components")
    more = links_between_components(members, roots, sets, full, percent, may_link, block_sets)
    if more.isEmpty():
        return roots
    return connected_components(links.unionByName(more))


def document_components(signed: DataFrame, names: DataFrame, roots: DataFrame) -> DataFrame:
    """``(doc, n_shingles, component_id, root)`` for every document.

    signed: ``sid, docs, n, k1, k2`` with ``docs`` an array of ``(id, name)``, name of a text; names: its distinct sets. The
    component's id is the least id of its documents, NULL only if all are; documents without shingles are alone, with no root.
    """
    keys = ["k1", "k2", "n"]
    rooted = names.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    per_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_rows"))
    n_names, n_rows = names.agg(F.count("*"), F.sum("n_rows")).first()
    hot = hot_keys(per_root, ["root"], n_names)
    found = join_in_parts(rooted, per_root.drop("n_rows"), ["root"], hot, F.col("sid"))
    found = stage(found.select(*keys, "root", "component_id", "n_rows"), "set-components")
    hot = hot_keys(found, keys, n_rows or 0)
    filled = signed.filter("n > 0").select(*keys, "sid", "docs")
    placed = join_in_parts(filled, found.select(*keys, "root", "component_id"), keys, hot, F.col("sid"))
    placed = placed.select(F.explode("docs").alias("doc"), F.col("n").alias("n_shingles"), "component_id", "root")
    alone = signed.filter("n = 0").select(F.explode("docs").alias("doc"), F.col("n").alias("n_shingles"))
    return placed.unionByName(alone.withColumns({"component_id": F.col("doc.id"), "root": F.lit(None).cast("long")}))


def distinct_names(signed: DataFrame) -> DataFrame:
    """Stored table of the distinct sets: the least ``sid`` of each, the least document id and the slices that have it."""
    least = F.array_min(F.transform("docs", lambda d: d["id"]))
    rows = signed.filter("n > 0").groupBy("k1", "k2", "n")
    return stage(rows.agg(F.min("sid").alias("sid"), F.min(least).alias("least"), F.count("*").alias("n_rows")), "set-names")
