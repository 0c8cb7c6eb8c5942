"""Running sums over ordered groups of any size, and digests of what an ordered group spells.

Rows are dealt by ranges of (group, order), so a group with a third of all rows is spread over
many tasks. A task streams its sorted rows and keeps one carried value; what a group had in
earlier tasks is one small row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

BITS = 62  # sums are modulo 2**BITS, so that two of them add up within a long
MASK = (1 << BITS) - 1


def masked(value: Column) -> Column:
    """A hash as a summand of `running`."""
    return value.bitwiseAND(F.lit(MASK))


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def running(table: DataFrame, group: Sequence[str], order: Sequence[str | Column], sums: Mapping[str, str], keep) -> DataFrame:
    """The rows with, for every entry `name: column` of `sums`, the sum of the column up to and
    with the row in its group. Group columns are longs without nulls, summed columns
    non-negative longs; sums are modulo 2**62. Rows that tie must be interchangeable."""
    salt = F.xxhash64(F.monotonically_increasing_id())
    ranged = table.withColumn("salt", salt)
    by = [F.col(c) for c in group] + [F.col(c) if isinstance(c, str) else c for c in order] + [F.col("salt")]
    ranged = ranged.repartitionByRange(*by).sortWithinPartitions(*by).drop("salt")
    names = list(sums)
    schema = T.StructType(
        [*table.schema.fields, *(T.StructField(n, T.LongType()) for n in names), T.StructField("part", T.IntegerType()),
         T.StructField("closes", T.BooleanType())])
    places = [table.columns.index(c) for c in group]
    values = [table.columns.index(c) for c in sums.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried, held = None, np.zeros((len(names), 1), np.uint64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in places]
            begin = _starts(keys)
            length = np.diff(np.append(begin, batch.num_rows))
            out = []
            for j, i in enumerate(values):
                total = np.cumsum(batch.column(i).to_numpy(zero_copy_only=False).astype(np.uint64), dtype=np.uint64)
                before = np.concatenate([np.zeros(1, np.uint64), total])[begin]
                if last == tuple(int(k[0]) for k in keys):
                    before[:1] -= carried[j]
                total -= np.repeat(before, length)
                total &= np.uint64(MASK)
                carried[j] = total[-1:]
                out.append(total.astype(np.int64))
            last = tuple(int(k[-1]) for k in keys)
            if held is not None:
                yield held
            marks = [np.full(batch.num_rows, part, np.int32), np.zeros(batch.num_rows, bool)]
            held = pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out), *map(pa.array, marks)], names=schema.names)
        if held is not None:
            closes = np.zeros(held.num_rows, bool)
            closes[-1] = True
            yield held.set_column(held.num_columns - 1, "closes", pa.array(closes))

    made = keep(ranged.mapInArrow(run, schema), "running")
    # one row per task: what its last group has so far, for the tasks in which that group goes on
    ends = sorted(made.filter("closes").select("part", *group, *names).collect())
    carries, open_ = [], None
    for row in ends:
        key, found = tuple(row[1 : 1 + len(group)]), list(row[1 + len(group) :])
        if open_ and open_[0] == key:
            carries.append((row[0], *key, *open_[1]))
            found = [(a + b) & MASK for a, b in zip(open_[1], found, strict=True)]
        elif open_:
            carries.append((row[0], *open_[0], *open_[1]))  # the group may end at the start of this task
        open_ = (key, found)
    made = made.drop("closes")
    if not carries:
        return made.drop("part")
    fields = ["part int", *(f"{c} long" for c in group), *(f"{n}_before long" for n in names)]
    before = table.sparkSession.createDataFrame(carries, ", ".join(fields))
    # at most one row per task of the sort
    joined = made.join(F.broadcast(before), ["part", *group], "left")
    return joined.select(*table.columns, *[
        (F.col(n) + F.coalesce(f"{n}_before", F.lit(0))).bitwiseAND(F.lit(MASK)).alias(n) for n in names])


def digests(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], separator: bytes = b"", totals: Sequence[str] = (),
) -> DataFrame:
    """Per key (longs) the SHA-256, as lowercase hex, of each binary column's values that are not
    null, in order, joined by `separator`; and the sums of the long columns `totals`. Rows of a
    key stream through one task, since the digest is sequential by definition; memory is that
    of a batch."""
    ordered = rows.select(*keys, *order, *values, *totals).repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, *values, *totals)
    schema = ", ".join([*(f"{k} long" for k in keys), *(f"{v}_sha256 string" for v in values), *(f"{t} long" for t in totals)])
    width, wide = len(keys), len(keys) + len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, states, sums = None, [], []

        def ended():
            return now, [s[0].hexdigest() for s in states], sums

        def batch_of(done):
            return pa.RecordBatch.from_arrays(
                [*(pa.array([d[0][i] for d in done], pa.int64()) for i in range(width)),
                 *(pa.array([d[1][j] for d in done], pa.string()) for j in range(len(values))),
                 *(pa.array([d[2][j] for d in done], pa.int64()) for j in range(len(totals)))],
                names=[*keys, *(f"{v}_sha256" for v in values), *totals])

        for batch in batches:
            if not batch.num_rows:
                continue
            found = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
            texts = [batch.column(width + j).to_pylist() for j in range(len(values))]
            counts = [batch.column(wide + j).to_numpy(zero_copy_only=False) for j in range(len(totals))]
            begin, done = _starts(found), []
            for a, b in zip(begin, [*begin[1:], batch.num_rows], strict=True):
                key = tuple(int(k[a]) for k in found)
                if key != now:
                    if now is not None:
                        done.append(ended())
                    now, states, sums = key, [[hashlib.sha256(), False] for _ in values], [0] * len(totals)
                for state, column in zip(states, texts, strict=True):
                    known = [t for t in column[a:b] if t is not None]
                    if known:
                        state[0].update((separator if state[1] else b"") + separator.join(known))
                        state[1] = True
                sums = [n + int(c[a:b].sum()) for n, c in zip(sums, counts, strict=True)]
            yield batch_of(done)
        if now is not None:
            yield batch_of([ended()])

    return ordered.mapInArrow(run, schema)
