"""Whitening of embeddings: each distinct vector is measured and whitened once, and the result joined back to its copies.

1. Entries become integers, and equal integer vectors are grouped with their number of copies.
2. Tasks add up the distinct vectors exactly; then each forms the weighted product of its centred block with itself, and
   the products are added row by row of the matrix. Only sums of the size of one vector and the covariance reach the driver.
3. Distinct vectors are projected on the leading eigenvectors, stored, and joined back to all rows. The covariance of what
   was stored tells how far it is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractweave.operators.scale import hot_keys, join_in_parts, stage


@dataclass(frozen=True)
class WhitenConfig:
    scale: int = 64
    shift: int = 1_000_000
    components: int = 16
    weights: str = "one"
    """``one``: every distinct vector counts once in sums and covariance; ``count``: as often as it occurs."""
    max_dims: int = 2048
    """The covariance is held by the driver and by each task, so its side is bounded."""

LARGEST = 2.0**53
"""Entries beyond are held there: a double has no unit digit above it."""


@dataclass(frozen=True)
class Fit:
    n: int
    """Weight of the fit list."""
    sums: list[int]
    values: np.ndarray
    """Eigenvalues by falling size, no more than the components asked for."""
    vectors: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        """Components with some variance; that of the others is nothing but rounding."""
        noise = self.values[0] * len(self.sums) * np.finfo(float).eps if len(self.values) else 0.0
        return int((self.values > max(noise, 0.0)).sum())

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The means as whole numbers and the rest, so that an entry is centred without rounding off its digits."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [float(Decimal(s - w * self.n) / self.n) for s, w in zip(self.sums, whole, strict=True)]
        return np.array(whole, np.int64), np.array(rest)


def integer_vectors(table: DataFrame, id_col: str, vector: str, config: WhitenConfig) -> DataFrame:
    """``(id, x, h1, h2)``: vectors without NULL or non-finite entries, as whole numbers, with a 128-bit name.

    Vectors of another length than most (of equally frequent lengths the largest) are left out.
    """
    rows = table.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()

    def whole(c: Column) -> Column:
        return F.floor(F.least(F.greatest(c * config.scale, F.lit(-LARGEST)), F.lit(LARGEST))).cast("long") + config.shift

    x = rows.filter(F.size("v") == (lengths.d if lengths else 0)).select("id", F.transform("v", whole).alias("x"))
    return x.withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x")})


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of a column of equally long arrays."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _weights(batch: pa.RecordBatch, config: WhitenConfig) -> np.ndarray:
    return batch.column("copies").to_numpy() if config.weights == "count" else np.ones(len(batch), np.int64)


def exact_sums(distinct: DataFrame, config: WhitenConfig) -> tuple[int, list[int]]:
    """Weight and sums per dimension of the fit list, in whole numbers of any size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, sums = 0, None
        for batch in batches:
            if not len(batch):
                continue
            x, w = matrix(batch.column("x"), np.int64), _weights(batch, config)
            if int(np.abs(x).max()) * int(w.sum()) >= 1 << 62:
                x, w = x.astype(object), w.astype(object)
            weight += int(w.sum())
            part = (x * w[:, None]).sum(axis=0).astype(object)
            sums = part if sums is None else sums + part
        if sums is not None:
            totals = [Decimal(int(s)) for s in (weight, *sums)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int32()), pa.array(totals, pa.decimal128(38, 0))], ["dim", "total"])

    rows = distinct.select("x", "copies").mapInArrow(add, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total")).orderBy("dim").collect()
    return (int(rows[0].total), [int(r.total) for r in rows[1:]]) if rows else (0, [])


def centred_products(rows: DataFrame, column: str, whole: np.ndarray, rest: np.ndarray, config: WhitenConfig) -> np.ndarray:
    """Weighted sum of outer products of ``column`` less its centre.

    Every task multiplies its block and sends the matrix row by row; the rows of a number are added in the order of the tasks.
    """
    kind = whole.dtype.type

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                y = (matrix(batch.column(column), kind) - whole).astype(np.float64) - rest
                part = (y * _weights(batch, config)[:, None]).T @ y
                total = part if total is None else total + part
        if total is not None:
            task = np.full(len(total), TaskContext.get().partitionId(), np.int32)
            lines = pa.array([line.tobytes() for line in total], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(task), lines], ["dim", "task", "line"])

    def add(lines: pa.Table) -> pa.Table:
        lines = lines.sort_by("task")
        total = np.sum([np.frombuffer(x, np.float64) for x in lines["line"].to_pylist()], axis=0)
        return pa.table({"dim": lines["dim"][:1], "line": pa.array([total.tobytes()], pa.binary())})

    sent = rows.select(column, "copies").mapInArrow(multiply, "dim int, task int, line binary")
    lines = sent.groupBy("dim").applyInArrow(add, "dim int, line binary").orderBy("dim").collect()
    return np.array([np.frombuffer(r.line, np.float64) for r in lines])


def fit_components(distinct: DataFrame, config: WhitenConfig) -> Fit | None:
    """Eigenvectors of the covariance of the fit list; None if there are no vectors or they have no entries."""
    n, sums = exact_sums(distinct, config)
    if not sums:
        return None
    start = Fit(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    covariance = centred_products(distinct, "x", *start.centre, config) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = np.maximum(values[::-1], 0.0)[: config.components], vectors[:, ::-1][:, : config.components]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return Fit(n, sums, values, vectors * np.where(signs == 0, 1, signs), float(np.trace(covariance)))


def _deviations(u: np.ndarray, rest: list[int], n: int) -> list[int | None]:
    """Sum over dimensions of (n u - rest)^2 in whole numbers; None where a long can't hold it."""
    limit, widest = 1 << 63, n * (int(np.abs(u).max()) + 1)
    if widest * widest * u.shape[1] < limit:
        return ((u * n - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((u.astype(object) * n - np.array(rest, object)) ** 2).sum(axis=1)
    return [int(s) if s < limit else None for s in exact]


def whiten_distinct(distinct: DataFrame, fit: Fit) -> DataFrame:
    """``(h1, h2, copies, deviation, whitened)``, each distinct vector once; components without variance are NULL."""
    whole, rest = fit.centre
    left_over = [s - int(w) * fit.n for s, w in zip(fit.sums, whole, strict=True)]
    rank = fit.rank
    scaled = fit.vectors[:, :rank] / np.sqrt(fit.values[:rank])
    blank = len(fit.values) - rank
    n = fit.n

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            u = matrix(batch.column("x"), np.int64) - whole
            out = (u.astype(np.float64) - rest) @ scaled
            known = np.concatenate([np.ones((len(out), rank), bool), np.zeros((len(out), blank), bool)], axis=1)
            flat = pa.array(np.concatenate([out, np.zeros((len(out), blank))], axis=1).reshape(-1), mask=~known.reshape(-1))
            offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * (rank + blank))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("h1", "h2", "copies")), pa.array(_deviations(u, left_over, n), pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                ["h1", "h2", "copies", "deviation", "whitened"],
            )

    return distinct.mapInArrow(project, "h1 long, h2 long, copies long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, fit: Fit, config: WhitenConfig) -> float:
    """Largest absolute entry of the covariance of what was stored less the identity, over the components with variance."""
    if fit.rank == 0:
        return 0.0
    rows = whitened.select(F.slice("whitened", 1, fit.rank).alias("w"), "copies")
    weight = F.col("copies") if config.weights == "count" else F.lit(1)
    means = rows.agg(*[(F.sum(F.get("w", F.lit(i)) * weight) / fit.n).alias(f"m{i}") for i in range(fit.rank)]).first()
    covariance = centred_products(rows, "w", np.zeros(fit.rank), np.array(means), config) / fit.n
    return float(np.abs(covariance - np.eye(fit.rank)).max())


def _joined_back(rows: DataFrame, whitened: DataFrame) -> DataFrame:
    """The whitened form of every row; vectors with very many copies are joined in parts."""
    keys = ["h1", "h2"]
    hot = hot_keys(whitened, keys, whitened.agg(F.sum("copies")).first()[0] or 0, "copies")
    return join_in_parts(rows.select("id", *keys), whitened.drop("copies"), keys, hot, F.col("id")).drop(*keys)


def whiten(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", config: WhitenConfig = WhitenConfig()) -> tuple[DataFrame, Fit | None, float]:
    """``(id, deviation, whitened)`` of every row with a whole vector, the fit, and the whitened covariance's distance from the identity.

    A vector's entries become ``floor(scale * entry) + shift`` (held within 2**53). Vectors that are NULL, hold NULL or
    non-finite entries, or have another length than most are left out; a NULL or repeated id is kept like any other. Fewer
    components come back if the vectors are shorter; components without variance (equal vectors, a single one) are NULL.
    ``deviation`` is exact, and NULL if a long can't hold it. An empty table, or vectors of no entries, give no rows. Other columns are
    not looked at.
    """
    if config.weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    rows = integer_vectors(table, id_col, vector, config)
    distinct = stage(rows.groupBy("h1", "h2", "x").agg(F.count("*").alias("copies")), "distinct-vectors")
    longest = distinct.agg(F.max(F.size("x"))).first()[0] or 0
    if longest > config.max_dims:
        raise ValueError(f"vectors of {longest} entries; at most {config.max_dims} are handled")
    fit = fit_components(distinct, config) if longest else None
    if fit is None:
        return rows.select("id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).limit(0), None, 0.0
    whitened = stage(whiten_distinct(distinct, fit), "whitened-vectors")
    return _joined_back(rows, whitened), fit, identity_error(whitened, fit, config)


def _numbers(values: Sequence[float | None]) -> Column:
    return F.array(*[F.lit(v).cast("double") for v in values])


def whitening_table(table: DataFrame, config: WhitenConfig = WhitenConfig()) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``explained`` is NULL if no vector differs from another. See ``whiten`` for unusual vectors.
    """
    rows, fit, error = whiten(table, config=config)
    shares = [float(e / fit.trace) if fit.trace > 0 else None for e in fit.values] if fit else [None]
    return rows.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fit.n if fit else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(_numbers(shares), F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
