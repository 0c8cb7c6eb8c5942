"""Near-duplicate vectors by spherical-cap filters.

Filter directions are the products of small random codebooks: the vector, rotated at random,
is cut into blocks, and a direction is one code word for each block. Its inner product with
a vector is a sum over blocks, so the directions that exceed the cap's threshold are listed
by extending partial sums that the best remaining words can still lift over it, never by
going through all directions. Each vector is sent to all its exceeding directions, and to at
least its best few; vectors that meet at a direction and have one label are compared by
cosine in double precision. The threshold falls with the number of vectors so that a
direction holds few unrelated ones. Several independent codes make a miss of a pair at the
least similarity rarer than one in a thousand.

Equal vectors of one label are one class with a count: classes are coded and compared, and a
link of two classes counts as often as the other class has vectors, so a group of copies costs
as much as one vector. Directions with many classes are compared block by block. A task gives
the number of links of each class and pairs that connect what is linked, not all pairs; a pair
that meets at several directions counts at the first.

A vector is scaled by a power of two to components of at most 1 before anything is squared.
That is exact and leaves its directions and cosines, so components of any magnitude that a
double holds neither overflow nor vanish.

Defined results: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null label, link with nothing; vectors of different lengths don't link; equal
vectors link; a null vec_id counts as a vector but names no component; rows that repeat an id
are vectors of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staffcast.llm.components import components
from staffcast.llm.words import mix

LEAST_COSINE = 0.98
CODES, BLOCKS = 4, 3
FILTERS, LEAST_FILTERS = 5, 4  # of a vector under each code: expected number, and least
PER_FILTER = 4  # unrelated vectors expected at a filter
BLOCK_ROWS = 1024
_U = np.uint64


def vectors(column: pa.Array) -> tuple[list[np.ndarray | None], np.ndarray]:
    """Rows as doubles, and which of them can be compared."""
    out, ok = [], np.zeros(len(column), dtype=bool)
    for i, row in enumerate(column):
        values = row.as_py()
        v = np.array([np.nan if x is None else x for x in values], dtype=np.float64) if values else None
        ok[i] = v is not None and bool(np.isfinite(v).all()) and bool(v.any())
        out.append(v if ok[i] else None)
    return out, ok


class Code:
    """One product code for vectors of some length."""

    def __init__(self, dim: int, words: int, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        blocks = min(BLOCKS, dim)
        self.bounds = np.linspace(0, dim, blocks + 1).astype(int)
        self.books = [rng.standard_normal((words, b - a)) for a, b in zip(self.bounds, self.bounds[1:], strict=False)]

    def exceeding(self, unit: np.ndarray, threshold: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and number of every direction with an inner product over the threshold, and of the
        `least` best ones of each row."""
        x = unit @ self.rotation.T
        parts = [x[:, a:b] @ book.T for a, b, book in zip(self.bounds, self.bounds[1:], self.books, strict=False)]
        rest = np.cumsum([p.max(axis=1) for p in parts][::-1], axis=0)[::-1]
        limit = np.full(len(x), threshold)
        while True:
            row, number, total = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
            for k, part in enumerate(parts):
                after = rest[k + 1] if k + 1 < len(parts) else np.zeros(len(x))
                sums = total[:, None] + part[row]
                at, word = np.nonzero(sums + after[row][:, None] >= limit[row][:, None])
                row, number, total = row[at], number[at] * part.shape[1] + word, sums[at, word]
            few = np.bincount(row, minlength=len(x)) < min(least, np.prod([float(p.shape[1]) for p in parts]))
            if not few.any():
                break
            limit[few] -= 0.15 * max(abs(threshold), 1.0)
        # of rows whose limit was lowered only the best stay
        order = np.lexsort((-total, row))
        row, number, total = row[order], number[order], total[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = (total >= threshold) | (place < least)
        return row[keep], number[keep]


_codes: dict[tuple, Code] = {}


def _code(dim: int, words: int, seed: int) -> Code:
    key = (dim, words, seed)
    if key not in _codes:
        _codes[key] = Code(*key)
    return _codes[key]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring the largest component of each to [0.5, 1); no zero is negative."""
    out = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    return out + 0.0


def _vectors(rows: DataFrame) -> DataFrame:
    """(owner, label, vec_id, vector): vectors as packed, scaled doubles, null for those that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                values, ok = vectors(part.column(3))
                ok &= np.array(part.column(1).is_valid())
                packed: list[bytes | None] = [None] * part.num_rows
                for dim in sorted({len(values[i]) for i in np.flatnonzero(ok)}):
                    here = [i for i in np.flatnonzero(ok) if len(values[i]) == dim]
                    for i, x in zip(here, scaled(np.stack([values[i] for i in here])), strict=True):
                        packed[i] = x.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(packed, pa.binary())], names=["owner", "label", "vec_id", "vector"])

    return rows.mapInArrow(run, "owner long, label long, vec_id long, vector binary")


def filters(classes: DataFrame, n: int) -> DataFrame:
    """owner, vector, copies and the packed, ascending keys of the label's filters of `n` classes
    (owner, label, vector, copies)."""
    per_filter = min(PER_FILTER, max(n, 2) / 2)
    threshold = -NormalDist().inv_cdf(per_filter / max(n, 2 * per_filter + 1)) if n > 2 * per_filter else 0.0
    words = max(2, int(np.ceil((FILTERS * max(n, 1) / per_filter) ** (1 / BLOCKS))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                label, packed = part.column(1).to_numpy(), part.column(2).to_pylist()
                length = np.array([len(v) for v in packed], dtype=np.int64)
                keys: list[bytes] = [b""] * part.num_rows
                for size in np.unique(length):
                    here, dim = np.flatnonzero(length == size), int(size) // 8
                    x = np.frombuffer(b"".join(packed[i] for i in here), np.float64).reshape(-1, dim)
                    unit = x / np.linalg.norm(x, axis=1)[:, None]
                    salt = mix(label[here].view(_U) ^ mix(np.full(len(here), dim, dtype=_U)))
                    found = [[] for _ in here]
                    for seed in range(CODES):
                        row, number = _code(dim, words, seed).exceeding(unit, threshold, LEAST_FILTERS)
                        for r, k in zip(row.tolist(), mix(mix(number.astype(_U) * _U(CODES) + _U(seed)) ^ salt[row]), strict=True):
                            found[r].append(k)
                    for j, i in enumerate(here):
                        keys[i] = np.sort(np.array(found[j], dtype=_U)).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(keys, pa.binary())], names=["owner", "vector", "copies", "filters"])

    return classes.select("owner", "label", "vector", "copies").mapInArrow(run, "owner long, vector binary, copies long, filters binary")


def _keys(rows: DataFrame) -> DataFrame:
    """(owner, filter) for every filter of a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = batch.column(0).to_numpy()
            lists = [np.frombuffer(f, np.int64) for f in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(owner, [len(x) for x in lists])), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))],
                names=["owner", "filter"])

    return rows.select("owner", "filters").mapInArrow(run, "owner long, filter long")


def _compare(least: float):
    def run(part: pa.Table) -> pa.Table:
        owner, block, copies = (part.column(c).to_numpy() for c in ("owner", "block", "copies"))
        first, second = part.column("i")[0].as_py(), part.column("j")[0].as_py()
        here = _U(part.column("filter")[0].as_py() % (1 << 64))
        x = np.stack([np.frombuffer(v, np.float64) for v in part.column("vector").to_pylist()])
        norm = np.linalg.norm(x, axis=1)
        a, b = np.flatnonzero(block == first), np.flatnonzero(block == second)
        cosine = (x[a] @ x[b].T) / norm[a][:, None] / norm[b]
        linked = cosine >= least
        if first == second:
            np.fill_diagonal(linked, False)
        # pairs that meet at a smaller filter count there
        lists = [np.frombuffer(f, _U) for f in part.column("filters").to_pylist()]
        size = np.array([len(x) for x in lists])
        value, holder = np.concatenate(lists), np.repeat(np.arange(len(lists)), size)
        smaller = value < here
        order = np.argsort(value[smaller], kind="stable")
        value, holder = value[smaller][order], holder[smaller][order]
        bounds = np.flatnonzero(np.append(np.append(True, value[1:] != value[:-1]), True)) if len(value) else []
        at_a, at_b = np.full(len(owner), -1), np.full(len(owner), -1)
        at_a[a], at_b[b] = np.arange(len(a)), np.arange(len(b))
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s > 1:
                h = holder[s:e]
                p, q = at_a[h], at_b[h]
                p, q = p[p >= 0], q[q >= 0]
                if len(p) and len(q):
                    linked[np.ix_(p, q)] = False
        n = np.zeros(len(owner), dtype=np.int64)
        n[a] += linked @ copies[b]
        if first != second:
            n[b] += copies[a] @ linked
        group, pairs = np.arange(len(owner)), []
        for i in np.flatnonzero(linked.any(axis=1)):
            for j in b[linked[i]]:
                if group[j] != group[a[i]]:
                    group[group == group[j]] = group[a[i]]
                    pairs.append((owner[a[i]], owner[j], 0))
        counted = np.flatnonzero(n)
        pairs = np.array(pairs, dtype=np.int64).reshape(-1, 3)
        return pa.table({"a": np.concatenate([owner[counted], pairs[:, 0]]), "b": np.concatenate([owner[counted], pairs[:, 1]]),
                         "n": np.concatenate([n[counted], pairs[:, 2]])})

    return run


def link(table: DataFrame, keep, least: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for rows (vec_id, label, embedding)."""
    rows = table.select(
        F.monotonically_increasing_id().alias("owner"), F.col("label").cast("long").alias("label"),
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    # equal vectors are found by a digest, so the vectors themselves travel once a class
    rows = keep(_vectors(rows).withColumn("digest", F.md5("vector")), "rows")
    same = ["label", "digest"]
    classes = keep(rows.filter("vector IS NOT NULL").groupBy(*same).agg(
        F.min("owner").alias("owner"), F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")), "classes")
    coded = keep(filters(classes, classes.count()), "filters")
    keys = keep(_keys(coded), "keys")
    crowds = keys.groupBy("filter").count().filter("count > 1").select(
        "filter", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
    met = keys.join(crowds, "filter").withColumn("block", F.pmod(F.xxhash64("owner"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = met.select("filter", "owner", "block", other).select(
        "filter", "owner", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    found = keep(met.join(coded, "owner").groupBy("filter", "i", "j").applyInArrow(_compare(least), "a long, b long, n long"), "found")
    counts = found.filter("n > 0").groupBy(F.col("a").alias("owner")).agg(F.sum("n").alias("others"))
    reached = components(found.filter("n = 0").select("a", "b"), keep).withColumnRenamed("node", "owner")
    joined = keep(classes.select(*same, "owner", "least_id", "copies").join(reached, "owner", "left").join(counts, "owner", "left").select(
        *same, "least_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("least", "owner").alias("group")), "grouped")
    names = joined.groupBy("group").agg(F.min("least_id").alias("component"))
    of_class = joined.join(names, "group").select(*same, "links", "component")
    out = rows.select("vec_id", *same).join(of_class, same, "left")
    # what links with nothing has no class and is its own component
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
