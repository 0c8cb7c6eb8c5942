"""Whitening of embeddings along their leading principal components.

Entries become integers, so counts and sums are exact. Every distinct vector counts once. The
components are eigenvectors of the covariance V of the distinct vectors, found by subspace
iteration with Chebyshev filters: a pass over the vectors gives V times a block of directions
as the sum of x'(xQ) over centred x, a polynomial recurrence of such passes damps all of the
spectrum below the block's least Ritz value, and QR and a Rayleigh-Ritz step turn the block
to the eigenvectors. It ends when the residuals of the wanted ones certify them at the
rounding of doubles. V itself is never formed, so a pass costs vectors x dimension x block.

A pass gives one block of sums a task; these are added in Spark, and the driver holds blocks
of the dimension only. Tasks read packed vectors, a fixed number to a row.

Defined results: a vector that is null or holds null or non-finite entries, or entries beyond
2**44, is left out; so is one whose length is not the most frequent one, of equals the larger;
repeated rows and ids have rows of their own; components without variance are left out, so one
distinct vector, or none, gives an empty result; a deviation beyond the range of a long is
null; other columns are ignored. Signs are such that a component's largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE = 256
LIMIT = 2.0**44  # entries beyond that would lose their place as scaled integers in sums
BLOCK_ROWS = 2048  # vectors of a packed row
GUARD = 28  # directions of the block beyond the wanted ones
DEGREE = 10  # of the filter
CERTAIN = 4e-15  # residual of a certified component, as a part of the largest eigenvalue and times sqrt(dimension)
NO_VARIANCE = 1e-13  # least eigenvalue of a component, as a part of the largest one


def _integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries as scaled whole doubles, where each row begins, and which rows are valid."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    ok = np.asarray(column.is_valid())
    length = np.nan_to_num(np.asarray(pa.compute.list_value_length(column).cast(pa.float64()))).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate([[0], np.cumsum(length)])
    bad = ~(np.abs(flat) <= LIMIT)
    row = np.repeat(np.arange(n), length)
    ok = ok.copy()
    ok[row[bad]] = False
    return np.floor(SCALE * np.where(bad, 0.0, flat)) + 0.0, first, ok


def scaled(table: DataFrame) -> DataFrame:
    """(vec_id, length, x) of valid rows (vec_id, embedding): x are packed 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, first, ok = _integers(batch.column(1))
            whole = flat.astype("<i8")
            at = np.flatnonzero(ok)
            packed = [whole[first[i] : first[i + 1]].tobytes() for i in at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array((first[1:] - first[:-1])[at].astype(np.int32)), pa.array(packed, pa.binary())],
                names=["vec_id", "length", "x"])

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, length int, x binary")


def _packed(vectors: DataFrame) -> DataFrame:
    """Vectors of one length, many to a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= BLOCK_ROWS:
                yield pa.RecordBatch.from_pydict({"n": [BLOCK_ROWS], "xs": [b"".join(held[:BLOCK_ROWS])]})
                held = held[BLOCK_ROWS:]
        if held:
            yield pa.RecordBatch.from_pydict({"n": [len(held)], "xs": [b"".join(held)]})

    return vectors.mapInArrow(run, "n long, xs binary")


def _added(blocks: DataFrame, size: int, dim: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of an array of `size` doubles or longs that `of` gives for a
    block of them. Tasks add up theirs, Spark adds up the tasks'; the driver gets `size` numbers."""
    probe = of(np.zeros((1, dim), dtype=np.int64))
    kind = "long" if probe.dtype.kind == "i" else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=probe.dtype)
        for batch in batches:
            for xs in batch.column(0).to_pylist():
                total += of(np.frombuffer(xs, "<i8").reshape(-1, dim))
        yield pa.RecordBatch.from_pydict({"place": np.arange(size), "value": total})

    # sums of longs are decimals, which don't overflow
    value = F.sum(F.col("value").cast("decimal(28,0)")) if kind == "long" else F.sum("value")
    found = blocks.select("xs").mapInArrow(run, f"place long, value {kind}").groupBy("place").agg(value.alias("value")).collect()
    out = np.zeros(size, dtype=object if kind == "long" else np.float64)
    for place, total in found:
        out[place] = int(total) if kind == "long" else total
    return out


class Fit(NamedTuple):
    """Distinct vectors `n`, sums of each dimension, components (columns), eigenvalues, and trace of V."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _orthonormal(block: np.ndarray) -> np.ndarray:
    return np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))[0]


def leading(apply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues and eigenvectors of the positive semidefinite operator
    `apply` (block to block), by Chebyshev-filtered subspace iteration."""
    width = min(dim, wanted + GUARD)
    q = _orthonormal(np.random.default_rng(seed).standard_normal((dim, width)))
    best, stalled = np.inf, 0
    while True:
        image = apply(q)
        # Rayleigh-Ritz
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        certain = residual <= CERTAIN * np.sqrt(dim) * max(values[0], 0.0)
        stalled = 0 if residual < best / 2 else stalled + 1
        best = min(best, residual)
        # at the rounding of the passes residuals stop falling; only there a stall ends the iteration
        if certain or stalled >= 3 and residual <= 1e-11 * values[0] or width == dim and stalled >= 1:
            return values[:wanted], q[:, :wanted]
        # the recurrence of scaled Chebyshev polynomials on [0, least Ritz value], which stay small there
        centre = max(values[-1], 1e-12 * values[0]) / 2
        sigma = first = centre / (centre - max(values[0], centre * 1.01))
        before, now = q, (image - centre * q) * (sigma / centre)
        for _ in range(DEGREE - 1):
            after = 1.0 / (2.0 / first - sigma)
            before, now = now, (apply(now) - centre * now) * (2.0 * after / centre) - before * (sigma * after)
            sigma = after
        q = _orthonormal(now)


def fit(vectors: DataFrame, dim: int, wanted: int, keep) -> tuple[Fit, DataFrame]:
    """The fit over distinct vectors `x` of one length, and the packed distinct vectors."""
    distinct = vectors.select("x").groupBy("x").agg(F.lit(1)).select("x")
    blocks = keep(_packed(distinct), "distinct")
    n = blocks.agg(F.sum("n")).first()[0] or 0
    if not n or not dim:
        return Fit(0, [], np.zeros((dim, 0)), np.zeros(0), 0.0), blocks
    sums = [int(s) for s in _added(blocks, dim, dim, lambda x: x.sum(axis=0))]
    mean = np.array([s / n for s in sums])
    trace = float(_added(blocks, 1, dim, lambda x: np.array([np.square(x - mean).sum()]))[0]) / n
    if trace == 0.0:
        return Fit(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0), blocks

    def apply(q: np.ndarray) -> np.ndarray:
        def pass_over(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return (centred.T @ (centred @ q)).ravel()

        return _added(blocks, q.size, dim, pass_over).reshape(q.shape) / n

    values, found = leading(apply, dim, min(wanted, dim))
    some = values > NO_VARIANCE * values[0]
    values, found = values[some], found[:, some]
    largest = found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])]
    return Fit(n, sums, found * np.sign(largest), values, trace), blocks


def identity_error(model: Fit, blocks: DataFrame) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    k, dim, mean = len(model.values), len(model.sums), model.mean
    into = model.components / np.sqrt(model.values)
    centre = _added(blocks, k, dim, lambda x: ((x - mean) @ into).sum(axis=0)) / model.n

    def squares(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ into - centre
        return (z.T @ z).ravel()

    return float(np.abs(_added(blocks, k * k, dim, squares).reshape(k, k) / model.n - np.eye(k)).max())


def whiten(table: DataFrame, keep, wanted: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each valid row
    (vec_id, embedding) and each of the first `wanted` components."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = keep(scaled(table), "scaled")
    lengths = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    dim = lengths[0]["length"] if lengths else 0
    rows = rows.filter(F.col("length") == dim)
    model, blocks = fit(rows, dim, wanted, keep)
    k = len(model.values)
    if not k:
        return table.sparkSession.createDataFrame([], schema)
    error, mean, into = identity_error(model, blocks), model.mean, model.components / np.sqrt(model.values)
    explained, n, sums = model.values / model.trace, model.n, model.sums

    def deviations(x: np.ndarray) -> list[int | None]:
        bound = int(np.abs(x).max()) * n + max(map(abs, sums))
        if bound * bound * dim < 2**62:
            return np.square(x * n - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
        return [d if d < 2**63 else None for d in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8").reshape(-1, dim)
            at = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(at), n)), pa.array(deviations(x), pa.int64()).take(pa.array(at)),
                 pa.array(((x - mean) @ into).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(at), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)
