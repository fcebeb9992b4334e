"""Connected components of a link table: links contracted in chunks inside tasks, then large-star and small-star steps.

A task turns a chunk of links into at most one link per node, to the least node that it reaches within the chunk. This is
repeated while it halves the links. If one chunk is left, it holds the components; else star steps over stored tables
bring the chunks' results together. No task ever holds more than a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractweave.operators.scale import drop_stage, hot_keys, join_in_parts, stage

CHUNK_LINKS = 1 << 20
"""Links that a task holds at once, some 100 MB with what contracting them takes. The result does not depend on it."""
HELD = 1000


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of links ``(a, b)``, and for each the least node that it is linked with over any number of them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        of_x, of_y = root[x], root[y]
        apart = of_x != of_y
        if not apart.any():
            return nodes, nodes[root]
        x, y, of_x, of_y = x[apart], y[apart], of_x[apart], of_y[apart]
        np.minimum.at(root, np.maximum(of_x, of_y), np.minimum(of_x, of_y))
        while ((up := root[root]) != root).any():
            root = up


def contract(batches: Iterator[pa.RecordBatch], chunk: int = CHUNK_LINKS, own: bool = False) -> Iterator[pa.RecordBatch]:
    """Links ``(a, b)`` to the least node each node reaches within a chunk of more than ``chunk`` links, or all there are.
    With ``own`` least nodes have a link to themselves."""

    def contracted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        node, root = least_reached(*(np.concatenate([x.column(c).to_numpy() for x in held]) for c in "ab"))
        kept = slice(None) if own else node != root
        return pa.RecordBatch.from_arrays([pa.array(node[kept]), pa.array(root[kept])], ["a", "b"])

    blocks, held, n = [], [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if len(held) == HELD:  # batches may be of one link, and each is some kilobyte
            blocks.append(pa.concat_batches(held))
            held = []
        if n > chunk:
            yield contracted(blocks + held)
            blocks, held, n = [], [], 0
    if n:
        yield contracted(blocks + held)


def _with_least(edges: DataFrame, own: bool, most: int) -> DataFrame:
    """``m``: the least neighbour of ``a``, or ``a`` itself if that is less. The links of a hub are dealt over several tasks."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n_rows"))
    hot = hot_keys(least, ["a"], most)
    m = F.least("a", "m") if own else F.col("m")
    return join_in_parts(edges, least.select("a", m.alias("m")), ["a"], hot, F.col("b"))


def _stars(edges: DataFrame) -> DataFrame:
    """Stored ``(a, b)``: every node but the least of a component with the least. Of each link of ``edges`` a is the larger node.

    Every step is two grouped minima joined back, written to the shared folder; hubs send one row per task to the minimum
    and take it back in parts, and the number of steps grows with the logarithm of the longest chain.
    """
    state = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first()
        if now == state or now[0] == 0:
            return edges
        state, most = now, 2 * now[0]
        # large-star: every larger neighbour of a node is hung on the node's least neighbour
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        large = _with_least(both, True, most).filter("b > a").selectExpr("b AS a", "m AS b").filter("a <> b").distinct()
        # small-star: a node and its smaller neighbours are hung on the least of them
        hung = _with_least(large, False, most)
        small = hung.selectExpr("b AS a", "m AS b").unionByName(hung.selectExpr("a", "m AS b")).filter("a <> b")
        before, edges = edges, stage(small.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
        drop_stage(edges.sparkSession, before)


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with over any number of links.

    ``links`` has ``a`` and ``b`` (long) and may repeat links. Self-links name nodes without links.
    """
    chunk = CHUNK_LINKS
    edges = stage(links.filter("a <> b").select("a", "b"), "links")
    n, more = edges.count(), True
    while n > chunk and more:
        parts = -(-n // chunk)
        before, edges = edges, stage(edges.coalesce(parts).mapInArrow(lambda rows: contract(rows, chunk), "a long, b long").distinct(), "links")
        drop_stage(edges.sparkSession, before)
        left = edges.count()
        n, more = left, 2 * left <= n
    if n <= chunk:
        return edges.coalesce(1).mapInArrow(lambda rows: contract(rows, chunk, own=True), "a long, b long").toDF("node", "root")
    roots = _stars(edges).selectExpr("a AS node", "b AS root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
