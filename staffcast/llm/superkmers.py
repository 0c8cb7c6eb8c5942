"""Substring dedup over windows of words by super-k-mer partitioning.

A window is `width` consecutive words of one document. A window whose words also start in a
document with a smaller id is a repeat, and every word that a repeat covers is removed.

Each window has a minimiser, the least hash of the word triples in it. Consecutive windows
with one minimiser travel as one packed string to the bucket of that minimiser, so equal
windows meet, at about three words of text for a window instead of thirteen. In a bucket the
windows are sorted; the first document of each run of equal ones keeps it.

Skew: windows that repeat among the documents of one chunk of a task are settled there, and
only the first document's copy travels on, so a passage that many documents share sends a
bucket one string a chunk. Minimisers of more than a fixed part of all windows are found by
counting first; their windows travel singly to the buckets of their own hashes.

Windows are compared by 128 bits of hash over all their words.

Defined results: a null, empty or short text has no windows and keeps all its words; equal
rows are treated alike, and rows of one id never make each other repeats; a null id counts
as larger than any other; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, functions as F

from staffcast.llm.packing import packed, unpacked
from staffcast.llm.words import CHUNK_BYTES, Words, chunks, cut, cut_bytes, hashes, mix, windows

WIDTH = 13
GRAM = 3  # words of a minimiser
BUCKET_BYTES = 6 << 20  # text for one bucket
HOT_PARTS = 1 << 20  # a minimiser with more than this part of all windows is hot, so at most so many are
LAST_ID = 2**63 - 1
_U = np.uint64


def minimisers(grams: np.ndarray, at: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The least of the hashes of the `width - gram + 1` grams that begin in each window."""
    span, size, least = width - gram + 1, 1, grams
    while 2 * size <= span:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    return np.minimum(least[at], least[at + span - size])


def _all_grams(hashed: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of `gram` words, also of those across texts, which no window holds."""
    n = len(hashed) - gram + 1
    out = hashed[:n].copy()
    for k in range(1, gram):
        out *= _U(0xD6E8FEB86659FD93)
        out += hashed[k : n + k]
    return mix(out)


def _windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes and the first word of every window."""
    first, at = windows(words, hashes(words, which=0), width)
    second, _ = windows(words, hashes(words, which=1), width)
    return first, second, at


def _starts_of_runs(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return new


def later_copies(first: np.ndarray, second: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks the windows of which an equal one has a smaller owner."""
    if not len(first):
        return np.zeros(0, dtype=bool)
    order = np.argsort(first)
    new = _starts_of_runs(first[order])
    if (second[order][1:] != second[order][:-1])[~new[1:]].any():  # equal in one hash only
        order = np.lexsort((second, first))
        new = _starts_of_runs(first[order]) | _starts_of_runs(second[order])
    begin = np.flatnonzero(new)
    least = np.minimum.reduceat(owner[order], begin)
    out = np.empty(len(first), dtype=bool)
    out[order] = owner[order] > np.repeat(least, np.diff(np.append(begin, len(first))))
    return out


def _spans(place: np.ndarray, row: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Windows in order of (place, row, at) as spans of words: place, row, start, end."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(at)) - 1
    return place[begin], row[begin], at[begin], at[stop[: len(begin)]] + width


_SENT = "bucket long, text binary, meta binary, n int, raw int"
_SENT_SCHEMA = pa.schema([("bucket", pa.int64()), ("text", pa.binary()), ("meta", pa.binary()), ("n", pa.int32()), ("raw", pa.int32())])
_META = np.dtype([("place", "<i8"), ("row", "<i4"), ("at", "<i4"), ("bytes", "<i4")])


def _columns(rows: np.ndarray) -> bytes:
    """Fields one after the other, ids as differences: what compresses well."""
    ids = np.diff(rows["place"], prepend=rows["place"].dtype.type(0))
    return b"".join([ids.tobytes(), *(np.ascontiguousarray(rows[f]).tobytes() for f in ("row", "at", "bytes"))])


def _rows(packed: bytes, n: int) -> np.ndarray:
    out = np.empty(n, dtype=_META)
    out["place"] = np.cumsum(np.frombuffer(packed, "<i8", n))
    for k, field in enumerate(("row", "at", "bytes")):
        out[field] = np.frombuffer(packed, "<i4", n, 8 * n + 4 * k * n)
    return out


def _docs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """place, the id in order; row, which tells texts of one id apart; text."""
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("place"),
        F.shiftright(F.xxhash64(text_col), 32).cast("int").alias("row"), F.col(text_col).cast("string").alias("text"))


def hot_minimisers(docs: DataFrame, width: int, gram: int, capacity: int, total_bytes: int) -> np.ndarray:
    """Minimisers of more than about `capacity` windows, sorted.

    A task sends on the counts that reach half of what a hot minimiser has in an average part
    of the same size; such parts hold at least half of its windows. With `capacity` at least
    1 / HOT_PARTS of all windows, at most 2 * HOT_PARTS come back, eight bytes each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sizes, seen = [], [], 0
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                words = cut(texts)
                hashed = hashes(words)
                _, at = windows(words, hashed, width)
                seen += len(words.data)
                if len(at):
                    values, n = np.unique(minimisers(_all_grams(hashed, gram), at, width, gram), return_counts=True)
                    found.append(values), sizes.append(n)
            if sum(map(len, found)) > 1 << 21:
                found, sizes = ([x] for x in _sum(found, sizes))
        if found:
            values, n = _sum(found, sizes)
            often = n >= max(2, capacity * seen / max(1, total_bytes) / 2)
            yield pa.RecordBatch.from_pydict({"minimiser": values[often].view(np.int64), "n": n[often]})

    counts = docs.select("text").mapInArrow(count, "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") * 2 > capacity).select("minimiser").toPandas()
    return np.sort(found["minimiser"].to_numpy(dtype=np.int64))


def _sum(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, inverse = np.unique(np.concatenate(values), return_inverse=True)
    return every, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Spans of words covered by repeats: place, row, start, end (in words, end excluded)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spark = docs.sparkSession
    n_buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    capacity = max(bucket_bytes // 24, total // HOT_PARTS)
    hot = spark.sparkContext.broadcast(hot_minimisers(docs, width, gram, capacity, total))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for begin, texts in chunks(batch.column(2), 2 * CHUNK_BYTES):
                place = batch.column(0).slice(begin, len(texts)).to_numpy()
                row = batch.column(1).slice(begin, len(texts)).to_numpy()
                words = cut(texts)
                first, second, at = _windows(words, width)
                if not len(at):
                    continue
                doc = words.rows()[at]
                here = later_copies(first, second, place[doc])
                out = []
                if here.any():  # settled in this chunk; passed on as spans
                    local = at[here] - words.first[doc[here]]
                    p, r, s, e = _spans(place[doc[here]], row[doc[here]], local, width)
                    meta = np.empty(len(p), dtype=_META)
                    meta["place"], meta["row"], meta["at"], meta["bytes"] = p, r, s, e
                    out.append((int(p[0] % n_buckets), None, packer.compress(_columns(meta)), len(meta), 0))
                go = ~here
                at, doc, first = at[go], doc[go], first[go]
                least = minimisers(_all_grams(hashes(words), gram), at, width, gram)
                single = np.isin(least.view(np.int64), hot.value)
                key = np.where(single, first, least)
                new = _starts_of_runs(key) | single
                new[1:] |= at[1:] != at[:-1] + 1
                run = np.flatnonzero(new)
                last = at[np.append(run[1:], len(at)) - 1] if len(run) else at[:0]
                bucket = (mix(key[run]) % _U(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                a, b = words.start[at[run]][order], words.end[last + width - 1][order]
                meta = np.empty(len(run), dtype=_META)
                meta["place"], meta["row"] = place[doc[run]][order], row[doc[run]][order]
                meta["at"], meta["bytes"] = (at[run] - words.first[doc[run]])[order], b - a
                raw = words.data.tobytes()
                cuts = list(map(slice, a.tolist(), b.tolist()))
                bounds = np.flatnonzero(_starts_of_runs(bucket[order])).tolist() + [len(run)]
                for x, y in zip(bounds, bounds[1:], strict=False):
                    text = b"".join(map(raw.__getitem__, cuts[x:y]))
                    out.append((int(bucket[order[x]]), packer.compress(text), packer.compress(_columns(meta[x:y])), y - x, len(text)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SENT_SCHEMA, strict=True)], schema=_SENT_SCHEMA)

    def settle(table: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        spans, metas, firsts, seconds, ats, owners = [], [], [], [], [], []
        slab, slab_rows, done = [], [], 0

        def cut_slab() -> None:
            # a run of words of one document is a text of its own here
            nonlocal done
            rows = np.concatenate(slab_rows)
            ends = np.cumsum(rows["bytes"], dtype=np.int64)
            words = cut_bytes(np.frombuffer(b"".join(slab), np.uint8), np.concatenate([[0], ends]))
            first, second, at = _windows(words, width)
            doc = words.rows()[at]
            firsts.append(first), seconds.append(second), owners.append(doc + done), metas.append(rows)
            ats.append(rows["at"][doc] + at - words.first[doc])
            done += len(rows)
            slab.clear(), slab_rows.clear()

        for text, meta, n, raw in zip(*(table.column(c) for c in ("text", "meta", "n", "raw")), strict=True):
            n, rows = n.as_py(), unpacker.decompress(meta.as_py(), max_output_size=20 * n.as_py())
            rows = _rows(rows, n)
            if not text.is_valid:
                spans.append((rows["place"], rows["row"], rows["at"], rows["bytes"]))
                continue
            slab.append(unpacker.decompress(text.as_py(), max_output_size=raw.as_py()))
            slab_rows.append(rows)
            if sum(map(len, slab)) > CHUNK_BYTES:
                cut_slab()
        if slab:
            cut_slab()
        if metas:
            meta, owner, at = np.concatenate(metas), np.concatenate(owners), np.concatenate(ats)
            copies = later_copies(np.concatenate(firsts), np.concatenate(seconds), meta["place"][owner])
            owner, at = owner[copies], at[copies]
            place, row = meta["place"][owner], meta["row"][owner]
            order = np.lexsort((at, row, place))
            spans.append(_spans(place[order], row[order], at[order], width))
        joined = [np.concatenate(c) for c in zip(*spans, strict=True)] if spans else [np.zeros(0, np.int64)] * 4
        kinds = (np.int64, np.int32, np.int32, np.int32)
        return pa.table({n: c.astype(k) for n, c, k in zip(("place", "row", "start", "end"), joined, kinds, strict=True)})

    return docs.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(settle, "place long, row int, start int, end int")


def remove_repeats(df: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Adds n_words, n_removed and `kept`, the remaining words joined by single spaces."""
    docs = _docs(df, id_col, text_col)
    spans = repeats(docs, width, gram, bucket_bytes).groupBy("place", "row").agg(
        F.collect_list("start").alias("span_start"), F.collect_list("end").alias("span_end"))
    names = ("n_words", "n_removed", "kept")
    kept = [c for c in df.columns if c not in names]
    others = [c for c in kept if c != text_col]
    own = {c: f"own_{i}" for i, c in enumerate(others)}
    keyed = df.select(
        *[F.col(f"`{c}`").alias(o) for c, o in own.items()],
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("place"),
        F.shiftright(F.xxhash64(text_col), 32).cast("int").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    joined = packed(keyed).join(spans, ["place", "row"], "left").drop("place", "row")
    added = {"text": "string", "n_words": "long", "n_removed": "long", "kept": "string"}
    schema = joined.select(*own.values(), *[F.lit(None).cast(k).alias(c) for c, k in added.items()]).schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {f.name: i for i, f in enumerate(batch.schema)}
            for begin, texts in unpacked(batch.column(columns["text"])):
                rows = batch.slice(begin, len(texts))
                words = cut(texts)
                starts, ends = rows.column(columns["span_start"]), rows.column(columns["span_end"])
                owner = np.repeat(np.arange(len(texts)), np.nan_to_num(pa.compute.list_value_length(starts).to_numpy(zero_copy_only=False)).astype(np.int64))
                change = np.zeros(len(words.start) + 1, dtype=np.int64)
                np.add.at(change, words.first[owner] + starts.flatten().to_numpy(), 1)
                np.add.at(change, words.first[owner] + ends.flatten().to_numpy(), -1)
                stays = np.cumsum(change[:-1]) == 0
                counts = words.counts
                left = np.diff(np.concatenate([[0], np.cumsum(stays)])[words.first])
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(columns[o]) for o in own.values()), texts, pa.array(counts), pa.array(counts - left),
                     keep_words(words, stays)], names=schema.names)

    out = joined.mapInArrow(apply, schema)
    back = {c: F.col(o).alias(c) for c, o in own.items()} | {text_col: F.col("text").alias(text_col)}
    return out.select(*[back[c] for c in kept], *names)


def keep_words(words: Words, stays: np.ndarray) -> pa.Array:
    """Per row the words that stay, joined by single spaces."""
    start, end = words.start[stays], words.end[stays]
    row_first = np.concatenate([[0], np.cumsum(stays)])[words.first]
    length = end - start
    n_of_row = np.diff(row_first)
    row = np.repeat(np.arange(len(n_of_row)), n_of_row)
    gap = np.ones(len(start), dtype=np.int64)
    gap[row_first[:-1][n_of_row > 0]] = 0  # no space before a row's first word
    put = np.cumsum(gap + length) - length
    total = int(put[-1] + length[-1]) if len(put) else 0
    out = np.full(total, 0x20, dtype=np.uint8)
    where = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(put, length) + where] = words.data[np.repeat(start, length) + where]
    row_bytes = np.zeros(len(n_of_row), dtype=np.int64)
    np.add.at(row_bytes, row, gap + length)
    offsets = np.concatenate([[0], np.cumsum(row_bytes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(n_of_row), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
