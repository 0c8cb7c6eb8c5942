"""Texts compressed one by one for a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from staffcast.llm.words import CHUNK_BYTES, chunks


def packed(df: DataFrame) -> DataFrame:
    """The same rows with `text`, the last column, compressed, for a shuffle."""
    schema = df.withColumn("text", F.lit(None).cast("binary")).schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for begin, texts in chunks(batch.column(batch.num_columns - 1)):
                raw = [None if t is None else packer.compress(t) for t in texts.cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.slice(begin, len(texts)).columns[:-1], pa.array(raw, pa.binary())], names=schema.names)

    return df.mapInArrow(pack, schema)


def unpacked(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Texts of a compressed column, some at a time, with the first one's row."""
    unpacker, begin, texts, size = zstandard.ZstdDecompressor(), 0, [], 0
    for i, raw in enumerate(column.to_pylist()):
        texts.append(None if raw is None else unpacker.decompress(raw))
        size += len(texts[-1] or b"")
        if size > CHUNK_BYTES:
            yield begin, pa.array(texts, pa.binary()).cast(pa.string())
            begin, texts, size = i + 1, [], 0
    if texts:
        yield begin, pa.array(texts, pa.binary()).cast(pa.string())
