"""Shingle sets of texts as sorted hash arrays, and counts of shared shingles over all texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from staffcast.llm.words import cut, hashes, mix, windows

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)


def sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every text the different hashes of its runs of `width` words, ascending, one text after
    the other, and where each text's begin. Fewer words are one run; no words are no set."""
    words = cut(texts)
    hashed = hashes(words, lower=True)
    values, at = windows(words, hashed, width)
    row = words.rows()[at]
    counts = words.counts
    for size in range(1, width):
        short = np.flatnonzero(counts == size)
        if len(short):
            whole = np.full(len(short), _U(size))
            for k in range(size):
                whole *= _STEP
                whole += hashed[words.first[short] + k]
            values, row = np.concatenate([values, mix(whole)]), np.concatenate([row, short])
    order = np.argsort(values)
    # texts of a chunk are few, so the second, stable sort runs over small integers
    order = order[np.argsort(row[order].astype(np.uint16 if len(texts) < 1 << 16 else np.int64), kind="stable")]
    values, row = values[order], row[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(texts) + 1))


def set_keys(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every set."""
    out = []
    for salt in (_U(0x2545F4914F6CDD1D), _U(0x9FB21C651E98DF25)):
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(values ^ salt), dtype=_U)])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + size[i] - 1 for every i, one after the other."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


_SENT = "bucket int, packed binary, n int"
_SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("packed", pa.binary()), ("n", pa.int32())])

Reader = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def frequent(table: DataFrame, read: Reader, capacity: int, entries: int) -> np.ndarray:
    """Hashes of more than about `capacity` sets with an estimate of that number, as two columns.

    A task sends on the counts that reach half of what such a hash has in an average part of
    the same size; those parts hold at least half of its entries. At most 2 * entries / capacity
    come back, sixteen bytes each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sizes, seen = np.zeros(0, _U), np.zeros(0, np.int64), 0
        for batch in batches:
            for values, _, _ in read(batch):
                here, n = np.unique(values, return_counts=True)
                seen += len(values)
                found, inverse = np.unique(np.concatenate([found, here]), return_inverse=True)
                sizes = np.bincount(inverse, np.concatenate([sizes, n]), minlength=len(found)).astype(np.int64)
        often = sizes >= max(2, capacity * seen / max(1, entries) / 2)
        yield pa.RecordBatch.from_pydict({"value": found[often].view(np.int64), "n": sizes[often]})

    counts = table.mapInArrow(count, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
    out = counts.filter(F.col("n") * 2 > capacity).toPandas()
    out = out.assign(u=out["value"].to_numpy(dtype=np.int64).view(_U)).sort_values("u")
    return np.stack([out["u"].to_numpy(dtype=_U), out["n"].to_numpy(dtype=np.int64).view(_U)], axis=1)


def shared_counts(table: DataFrame, read: Reader, n_buckets: int, hot: np.ndarray | None = None,
                  n_groups: int = 1) -> DataFrame:
    """Which hashes occur in at least two sets.

    `read` gives (hashes, row of each, owner of each row) for parts of a batch. Without values
    the result is (owner, hits), the number of an owner's hashes that are shared; with values
    it is (group, packed, n) for `answers`: the shared hashes of the owners of a group with
    their numbers of owners, and for every owner its number of hashes. Buckets answer groups of
    owners, in packed rows, so the rows do not grow with buckets times owners.

    Hashes travel packed by bucket. One that several sets of a part hold is known to be shared
    there, so its owners are answered on the spot and one copy with their number travels on:
    a hash in a third of all texts sends its bucket one entry a part, not one a text. With
    `hot`, the table of frequent hashes, the result has values: every owner must hear the
    total, so all entries travel, but for those in `hot`, which are answered on the spot.
    """
    with_values = hot is not None
    known = table.sparkSession.sparkContext.broadcast(hot)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for values, row, owners in read(batch):
                if not len(values):
                    continue
                order = np.argsort(values, kind="stable")
                v, r = values[order], row[order]
                new = np.ones(len(v), dtype=bool)
                new[1:] = v[1:] != v[:-1]
                begin = np.flatnonzero(new)
                size = np.diff(np.append(begin, len(v)))
                out = []
                if with_values:
                    at = np.minimum(np.searchsorted(known.value[:, 0], v), max(0, len(known.value) - 1))
                    often = known.value[at, 0] == v if len(known.value) else np.zeros(len(v), bool)
                    counts = np.bincount(row, minlength=len(owners))
                    told = (np.concatenate([np.zeros(len(owners), _U), v[often]]), np.concatenate([owners, owners[r[often]]]),
                            np.concatenate([-counts, known.value[at[often], 1].view(np.int64) if often.any() else counts[:0]]))
                    out.append((-1, packer.compress(b"".join(t.tobytes() for t in told)), len(told[0])))
                    v, r = v[~often], r[~often]
                    owner, n = owners[r], np.ones(len(v), np.int32)
                else:
                    many = np.repeat(size > 1, size)
                    hits = np.bincount(r[many], minlength=len(owners))
                    some = np.flatnonzero(hits)
                    if len(some):
                        out.append((-1, packer.compress(owners[some].tobytes() + hits[some].tobytes()), len(some)))
                    v, owner, n = v[begin], owners[r[begin]], size.astype(np.int32)
                bucket = ((v >> _U(20)) % _U(n_buckets)).astype(np.int32)
                o = np.argsort(bucket, kind="stable")
                v, owner, n, bucket = v[o], owner[o], n[o], bucket[o]
                bounds = np.flatnonzero(np.append(np.append(True, bucket[1:] != bucket[:-1]), True))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    ids = np.diff(owner[a:b], prepend=0)
                    packed = v[a:b].tobytes() + ids.tobytes() + n[a:b].tobytes()
                    out.append((int(bucket[a]), packer.compress(packed), b - a))
                # answers need no bucket; they are dealt out beside the others
                out = [((k if k >= 0 else int(owners[0] % n_buckets)) + (0 if k >= 0 else n_buckets), p, m) for k, p, m in out]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SENT_SCHEMA, strict=True)], schema=_SENT_SCHEMA)

    def settle(part: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        answer = part.num_rows and part.column("bucket")[0].as_py() >= n_buckets
        cols: list[list[np.ndarray]] = [[], [], []]
        for packed, n in zip(part.column("packed"), part.column("n"), strict=True):
            n = n.as_py()
            raw = unpacker.decompress(packed.as_py(), max_output_size=24 * n)
            if answer and with_values:
                for c, kind, k in zip(cols, ("<u8", "<i8", "<i8"), range(3), strict=True):
                    c.append(np.frombuffer(raw, kind, n, 8 * n * k))
            elif answer:
                cols[0].append(np.frombuffer(raw, "<i8", n)), cols[1].append(np.frombuffer(raw, "<i8", n, 8 * n))
            else:
                cols[0].append(np.frombuffer(raw, "<u8", n))
                cols[1].append(np.cumsum(np.frombuffer(raw, "<i8", n, 8 * n)))
                cols[2].append(np.frombuffer(raw, "<i4", n, 16 * n))
        if answer and not with_values:
            owner, hits = np.concatenate(cols[0]), np.concatenate(cols[1])
            return by_group(np.zeros(len(owner), _U), owner, hits)
        v, owner, n = map(np.concatenate, cols)
        if answer:
            return by_group(v, owner, n)
        order = np.argsort(v)
        v, owner, n = v[order], owner[order], n[order]
        begin = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        size = np.diff(np.append(begin, len(v)))
        total = np.repeat(np.add.reduceat(n.astype(np.int64), begin), size)
        if with_values:
            return by_group(v[total > 1], owner[total > 1], total[total > 1])
        keep = (total > 1) & (n == 1)
        found, hits = np.unique(owner[keep], return_counts=True)
        return by_group(np.zeros(len(found), _U), found, hits)

    def by_group(v: np.ndarray, owner: np.ndarray, total: np.ndarray) -> pa.Table:
        packer = zstandard.ZstdCompressor(level=1)
        group = (mix(owner.view(_U)) % _U(n_groups)).astype(np.int64)
        o = np.lexsort((owner, group))
        group, owner, v, total = group[o], owner[o], v[o], total[o]
        bounds = np.flatnonzero(np.append(np.append(True, group[1:] != group[:-1]), True)) if len(o) else []
        rows = [(int(group[a]), packer.compress(v[a:b].tobytes() + np.diff(owner[a:b], prepend=0).tobytes() + total[a:b].astype(np.int64).tobytes()), int(b - a))
                for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pa.table({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate((("group", pa.int64()), ("packed", pa.binary()), ("n", pa.int32())))})

    def add_up(part: pa.Table) -> pa.Table:
        _, owner, hits = answers(part)
        owner, inverse = np.unique(owner, return_inverse=True)
        return pa.table({"owner": owner.astype(np.int64), "hits": np.bincount(inverse, hits).astype(np.int64)})

    answered = table.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(settle, "group long, packed binary, n int")
    return answered if with_values else answered.groupBy("group").applyInArrow(add_up, "owner long, hits long")


def answers(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, owner and number of owners of all answers of a group; for each owner also one with
    hash 0 and the number of its hashes, negative."""
    unpacker, cols = zstandard.ZstdDecompressor(), [[], [], []]
    for packed, n in zip(part.column("packed").to_pylist(), part.column("n").to_pylist(), strict=True):
        raw = unpacker.decompress(packed, max_output_size=24 * n)
        cols[0].append(np.frombuffer(raw, "<u8", n)), cols[2].append(np.frombuffer(raw, "<i8", n, 16 * n))
        cols[1].append(np.cumsum(np.frombuffer(raw, "<i8", n, 8 * n)))
    return tuple(map(np.concatenate, cols))


def bucket_count(spark: SparkSession, entries: int, most: int = 1 << 20) -> int:
    """Buckets of at most about `most` entries, and at least two for each shuffle partition."""
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // most))

