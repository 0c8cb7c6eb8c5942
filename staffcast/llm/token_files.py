"""Token counts of documents in flat, unindexed token files, by scanning for separators.

A token file is 16-bit big-endian identifiers one after the other, with the separator's after
each document, and nothing else. Files are read in blocks of bytes by the text source, which
splits files of any size and any store: it cuts at the separator's last byte, and joining its
lines with that byte gives back the bytes of a part of a block. Whether a part begins at an
even place of its file is only known once the lengths of all parts before it are added up, so
a part is searched for separators at even and at odd places with whole-array comparisons. A
prefix scan over the parts of a file then gives each part its place, which parity holds, how
many documents ended before it, and where the document began that its first separator ends.

The files say nothing of whose tokens they hold. `document_order` lists the ids of the table that
they were written from, by the number of the task and so of the file, and by place.

Defined results: an empty document (a null or empty text) counts 0 tokens; identifiers behind
the last separator are a document without an end, reported with `ended` false; an odd last
byte belongs to no identifier; an empty table gives no files and no rows; repeated rows are
documents of their own. The separator's last byte must be an ASCII character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from staffcast.llm import bpe

SEPARATOR = 50256  # the free identifier behind the vocabulary
PART_BYTES = 4 << 20
_KIND = np.dtype(">u2")


def write_token_files(docs: DataFrame, folder: str, ranks_path: str, pattern: str, separator: int = SEPARATOR) -> None:
    """Encodes the texts and writes one flat file a task, without a shuffle.

    The text sink ends each row with the separator's last byte; rows hold all before it.
    """
    first, last = separator >> 8, separator & 255
    if last > 127 or separator > 65535:
        raise ValueError("the separator's last byte must be ASCII")

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for packed in batch.column(0).to_pylist():
                ids = np.frombuffer(packed, "<u4")
                if len(ids) and int(ids.max()) > 65535:
                    raise ValueError("identifiers must fit 16 bits")
                rows.append(ids.astype(_KIND).tobytes() + bytes([first]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    encoded = bpe.encode(docs.select("text"), ranks_path, pattern).select("ids")
    raw = encoded.mapInArrow(flat, "value binary")
    raw.select(F.col("value").cast("string").alias("value")).write.option("lineSep", chr(last)).text(folder)


def document_order(docs: DataFrame) -> DataFrame:
    """(file_number, document, doc_id) of the files that `write_token_files` makes of the same
    table. That must be a scan of files: its tasks have the same rows, in the same order, whichever
    columns are read, as they depend on the files' sizes only. Write other tables first."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, file = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, file, np.int32)), pa.array(np.arange(seen, seen + n)), batch.column(0)], names=["file_number", "document", "doc_id"])
            seen += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id").mapInArrow(number, f"file_number int, document long, doc_id {kind}")


def _parts(spark: SparkSession, folder: str, separator: int) -> DataFrame:
    """file, block, place (of the part in its block), bytes, and packed places behind separators
    at even and odd places of the part."""
    first, last = separator >> 8, separator & 255
    lines = spark.read.option("lineSep", chr(last)).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_bytes"), F.col("value").cast("binary").alias("value"))
    names = ["file", "block", "file_bytes", "place", "bytes", "even", "odd"]
    schema = "file string, block long, file_bytes long, place long, bytes long, even binary, odd binary"
    end = bytes([last])

    def search(at: tuple, place: int, held: list[bytes]) -> tuple:
        data = np.frombuffer(end.join(held) + end, np.uint8)
        behind = np.flatnonzero((data[:-1] == first) & (data[1:] == last)).astype(np.int64) + 2
        return (*at, place, len(data), behind[behind % 2 == 0].tobytes(), behind[behind % 2 == 1].tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place, held, size = None, 0, [], 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.string(), *[pa.int64()] * 4, pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

        for batch in batches:
            rows = []
            for file, block, file_bytes, value in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if at is not None and (file, block) != at[:2] or size > PART_BYTES:
                    rows.append(search(at, place, held))
                    place = place + size if (file, block) == at[:2] else 0
                    held, size = [], 0
                at = (file, block, file_bytes)
                held.append(value)
                size += len(value) + 1
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of([search(at, place, held)])

    return lines.mapInArrow(run, schema)


def count_tokens(spark: SparkSession, folder: str, keep, separator: int = SEPARATOR) -> DataFrame:
    """One row per document: file, document (its number in the file), start (its first token's
    number), n_tokens, ended."""
    parts = keep(_parts(spark, folder, separator), "parts")
    before = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    placed = parts.withColumn("base", base).withColumn("behind", F.when(F.col("base") % 2 == 0, F.col("even")).otherwise(F.col("odd")))

    def last_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [np.frombuffer(x, np.int64) for x in batch.column(3).to_pylist()]
            base = batch.column(2).to_pylist()
            last = [int(b + e[-1]) if len(e) else None for b, e in zip(base, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(e) for e in ends], pa.int64()), pa.array(last, pa.int64())],
                names=["file", "file_bytes", "base", "behind", "n", "last"])

    ends = placed.select("file", "file_bytes", "base", "behind").mapInArrow(
        last_end, "file string, file_bytes long, base long, behind binary, n long, last long")
    before = Window.partitionBy("file").orderBy("base").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("file").orderBy("base").rowsBetween(1, Window.unboundedFollowing)
    scanned = keep(
        ends.withColumn("number", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("began", F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(0)))
        .withColumn("final", F.count("file").over(after) == 0), "scanned")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, total, base, behind, number, began, final in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                end = base + np.frombuffer(behind, np.int64)
                start = np.append(began, end)
                n = len(end)
                size = (end - start[:-1]) // 2 - 1
                ended = np.ones(n, dtype=bool)
                if final and total - start[-1] >= 2:
                    n, size, ended = n + 1, np.append(size, (total - start[-1]) // 2), np.append(ended, False)
                out.append(([file] * n, number + np.arange(n), start[:n] // 2, size, ended))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for c in cols[0] for f in c], pa.string()), *(pa.array(np.concatenate(c)) for c in cols[1:])],
                names=["file", "document", "start", "n_tokens", "ended"])

    return scanned.select("file", "file_bytes", "base", "behind", "number", "began", "final").mapInArrow(
        documents, "file string, document long, start long, n_tokens long, ended boolean")
