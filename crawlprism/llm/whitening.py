"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers, so sums are exact, and rows are centred before anything is multiplied. A pass over the rows
gives the Gram matrix of the centred rows divided by the triangular factors found so far; its Cholesky factor is the next
one. The first Gram matrix is shifted by a multiple of the rounding error, and later ones where they are not positive,
so that ill-conditioned data go through. When a pass finds orthonormal columns (or columns of zeros) the factors are
composed to R, and the singular value decomposition of R gives the components without ever squaring the condition number.

A task keeps one d x d matrix and hands it on by rows; these are added by row and only the sum, d x d, comes to the driver.
Sums are added in the order of the tasks, so reruns over the same partitions agree to the last bit.

Rows whose vector is null or holds null or non-finite entries are dropped; so are empty vectors and, where lengths differ,
rows whose length isn't the most frequent (the longer of two). Entries beyond ``LARGEST`` count as that. Rows are told
apart by nothing, so repeated and null ids are rows of their own. Components whose singular value is within ``NOISE`` of the
largest are rounding errors and left out, so equal rows, one row or an empty table give none. A deviation that a long
can't hold is null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlprism.session import materialize

COMPONENTS = 32
# An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**34
NOISE = 1e-11
# Columns are orthonormal when no entry of the Gram matrix is further off than this.
ORTHONORMAL = 1e-12
MOST_PASSES = 10
_ROUNDING = 2.0**-53
# Rows worked on at once.
_ROWS = 1024

Map = Callable[[np.ndarray], np.ndarray]


def whole_rows(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """``(vec_id, x)`` of the rows that stay, ``x`` the vector in whole numbers, and its length."""
    v = F.col("embedding")
    finite = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    # A look-up without side effects on bad rows: they are null here, and dropped.
    near = lambda c: F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform(v, lambda c: F.floor(near(c) * SCALE) + OFFSET)
    rows = embeddings.select("vec_id", F.when(finite, x).alias("x")).filter("x IS NOT NULL AND size(x) > 0")
    rows = materialize(rows, "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(2).collect()
    if not lengths:
        return rows, 0
    d = lengths[0]["d"]
    return (rows.filter(F.size("x") == d) if len(lengths) > 1 else rows), d


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part, part.column("x").flatten().to_numpy().reshape(-1, d)


def totals(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(d, np.int64), 0
        for _, x in _blocks(batches, d):
            sums, n = sums + x.sum(axis=0), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(sums), pa.array([n] * d, pa.int64())], ["i", "s", "n"])

    parts = rows.select("x").mapInArrow(partial, "i int, s bigint, n bigint")
    got = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    return got[0]["n"], [int(r["s"]) for r in got]


def gram(rows: DataFrame, d: int, of: Map, width: int) -> np.ndarray:
    """The sum of ``aᵀa`` over blocks ``a = of(x)`` of all rows, ``width`` columns wide."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in _blocks(batches, d):
            a = of(x)
            total += a.T @ a
        task = [TaskContext.get().partitionId()] * width
        lines = [line.tobytes() for line in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(task, pa.int32()), pa.array(lines, pa.binary())], ["i", "task", "line"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, line in zip(batch.column("i").to_pylist(), batch.column("line").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0.0) + np.frombuffer(line)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["i", "line"])

    parts = rows.select("x").mapInArrow(partial, "i int, task int, line binary")
    lines = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(added, "i int, line binary").collect()
    out = np.zeros((width, width))
    for r in lines:
        out[r["i"]] = np.frombuffer(r["line"])
    return (out + out.T) / 2


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: whole part and rest of ``n`` times the mean, components in columns, and their variances."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def whitened(self, x: np.ndarray, most: int) -> np.ndarray:
        return self.centred(x) @ (self.components[:, :most] / np.sqrt(self.variances[:most]))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n x - S)²`` of each row."""
        far = float(self.n) * (np.abs(x - self.whole).max(initial=0) + 1.0)
        if far * far * x.shape[1] < 2.0**62:
            off = self.n * (x - self.whole) - self.rest
            return (off * off).sum(axis=1).tolist()
        off = self.n * (x - self.whole).astype(object) - self.rest.astype(object)
        return [s if s < 1 << 63 else None for s in (off * off).sum(axis=1)]


def fit(rows: DataFrame, d: int) -> Whitening:
    """Components of ``rows (x)``, by passes of Cholesky factors until the columns are orthonormal."""
    n, sums = totals(rows, d)
    whole, rest = (np.array(v, np.int64) for v in zip(*(divmod(s, n) for s in sums), strict=True))
    factors: list[np.ndarray] = []
    passes = 0

    def divided(x: np.ndarray) -> np.ndarray:
        a = ((x - whole) - rest / n).T
        for r in factors:
            a = np.linalg.solve(r.T, a)
        return a.T

    while True:
        g = gram(rows, d, divided, d)
        passes += 1
        if not g.any() or (factors and np.abs(g @ g - g).max() <= ORTHONORMAL) or passes == MOST_PASSES:
            break
        shift = 11 * d * (d + 1) * _ROUNDING * np.trace(g)
        try:
            factor = np.linalg.cholesky(g + (0.0 if factors else shift) * np.eye(d))
        except np.linalg.LinAlgError:
            factor = np.linalg.cholesky(g + shift * np.eye(d))
        factors.append(factor.T)
    # What the last pass found off the identity goes into R as well.
    values, vectors = np.linalg.eigh(g)
    r = (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T
    for factor in reversed(factors):
        r = r @ factor
    _, s, v = np.linalg.svd(r)
    real = s > NOISE * s[0]
    variances = s * s / n
    return Whitening(n, whole, rest, v[real].T, variances[real], float(variances.sum()), passes)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row for each row that stays and component."""
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows, d = whole_rows(embeddings)
    model = fit(rows, d) if d else None
    k = min(components, len(model.variances)) if model else 0
    if not k:
        return embeddings.sparkSession.createDataFrame([], schema)
    # A column of ones next to the components gives their sums.
    g = gram(rows, d, lambda x: np.column_stack([np.ones(len(x)), model.whitened(x, k)]), k + 1) / model.n
    error = float(np.abs(g[1:, 1:] - np.outer(g[0, 1:], g[0, 1:]) - np.eye(k)).max())
    explained = model.variances[:k] / model.trace

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, d):
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.whitened(x, k).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [c.split()[0] for c in schema.split(", ")],
            )

    return rows.mapInArrow(out, schema)
