"""Cross-entropy difference of documents under matched n-gram models of a target and a background.

Both models are bigram models over one vocabulary, all words of the background, and have the
same smoothing: a bigram's count is mixed with `prior` times the word's unigram probability. A
document's score is its mean loss per token under the target less that under the background;
the lower, the more it is like the target.

Counts cover all documents. The most frequent words have ids, and their unigram counts are
broadcast; all other words go by their 63-bit hashes and nothing about them is broadcast. A
bigram whose word is such travels to the word's bucket, which has all of its occurrences and
so its unigram count; one whose context alone is such travels to the context's bucket, as does
an entry of its own that counts the context. So a packet names a hash once for all its bigrams.
Bigrams of two of the most frequent words are counted in dense tables of a fixed size, summed
and broadcast, and scored where the text is.

Documents are first written in chunks of about a megabyte. A chunk asks each bucket, in one
packed row, for the counts of its different bigrams, adding its own numbers of them in the
background and in those of its rows that are the target, and gets one packed row back. So what
repeats in a chunk travels once, a bigram that very many documents have loads its bucket with
one entry a chunk, and no text travels by document: which rows are the target is found from
ids and places alone, and the chunk's texts are read again and scored with the counts beside them.

Defined results: a null text or one without words has no tokens and null losses and score;
every row has a result of its own, whatever its id, and equal texts score alike; with an empty
target every loss under it is that of the uniform model; an empty table gives an empty
result; other columns are ignored; a text longer than a chunk is a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from staffcast.llm.words import Words, chunks, cut, cut_bytes, hashes, mix

TABLE = 1 << 16  # words with ids; bounds what is broadcast, not which words are counted
DENSE = 512  # ids whose bigrams are counted in dense tables
PRIOR = 50.0
BUCKET_ENTRIES = 1 << 20
CHUNK_BYTES = 1 << 20  # of text; packed it is no huge object for the JVM's heap
_UNKNOWN, _BEGIN, _WORDS = 0, 1, 2
_U = np.uint64
_HASHED = _U(1 << 63)  # marks codes that are hashes of words without an id
_CONTEXT = _U(_UNKNOWN)  # in place of the word of a bigram with a hashed context: all its occurrences
_AFTER = _U(1 << 40)  # marks the id of a word that is listed by its hashed context


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, sizes = np.zeros(0, _U), np.zeros(0, np.int64)
    for batch in batches:
        for _, texts in chunks(batch.column(0)):
            here, n = np.unique(hashes(cut(texts), lower=True), return_counts=True)
            found, inverse = np.unique(np.concatenate([found, here]), return_inverse=True)
            sizes = np.bincount(inverse, np.concatenate([sizes, n]), minlength=len(found)).astype(np.int64)
            if len(found) > 1 << 21:  # bounds the task's memory; counts are summed after the shuffle
                yield pa.RecordBatch.from_pydict({"word": found.view(np.int64), "n": sizes})
                found, sizes = found[:0], sizes[:0]
    yield pa.RecordBatch.from_pydict({"word": found.view(np.int64), "n": sizes})


def _counted(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _all_words(texts: DataFrame, keep) -> tuple[np.ndarray, int]:
    """Hashes of the most frequent words, at most TABLE, and the number of all different words.

    A histogram of counts by powers of two, at most 64 rows, gives the least count that few
    enough words reach; only words of that count leave the table of counts.
    """
    counts = keep(texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    power = F.floor(F.log2("n")).cast("int").alias("power")
    histogram = sorted(((r.power, r["count"]) for r in counts.groupBy(power).count().collect()), reverse=True)
    least, reached = 62, 0
    for power, n in histogram:
        if reached + n > TABLE:
            break
        least, reached = power, reached + n
    rows = counts.filter(F.col("n") >= 2**least).toPandas()
    order = np.lexsort((rows["word"], -rows["n"]))
    return rows["word"].to_numpy(dtype=np.int64)[order].view(_U), sum(n for _, n in histogram)


class Ids:
    """Codes of words by their hashes: 1 stands before a text, then ids by frequency; all others
    are their hashes under the mark _HASHED."""

    def __init__(self, words: np.ndarray):
        self.order = np.argsort(words)
        self.sorted = words[self.order]
        self.size = _WORDS + len(words)

    def bigrams(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context code, word code and row of every word."""
        h = hashes(words, lower=True)
        ids = h | _HASHED
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            known = self.sorted[at] == h
            ids[known] = (self.order[at[known]] + _WORDS).astype(_U)
        before = np.empty_like(ids)
        before[1:] = ids[:-1]
        before[words.first[:-1][words.counts > 0]] = _BEGIN
        return before, ids, words.rows()


def _ids(codes: np.ndarray) -> np.ndarray:
    """Ids as places in tables; hashed codes share place 0."""
    return np.where(codes < _HASHED, codes, _U(_UNKNOWN)).astype(np.int64)


def _dense_counts(parts: DataFrame, known) -> list[tuple[np.ndarray, np.ndarray]]:
    """For target and background, counts of all ids as contexts and words, and of bigrams of the
    DENSE first ids. Hashed words are counted together, at 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(known.value)
        total = np.zeros((2, 2 * ids.size + DENSE * DENSE), dtype=np.int64)
        for batch in batches:
            for _, words, shares in _shares(batch):
                every_before, every_word, row = ids.bigrams(words)
                for sums, share in zip(total, shares, strict=True):
                    if share.any():
                        before, word = every_before[share[row]], every_word[share[row]]
                        sums[: ids.size] += np.bincount(_ids(before), minlength=ids.size)
                        sums[ids.size : 2 * ids.size] += np.bincount(_ids(word), minlength=ids.size)
                        both = (before < DENSE) & (word < DENSE)
                        sums[2 * ids.size :] += np.bincount(_ids(before[both]) * DENSE + _ids(word[both]), minlength=DENSE * DENSE)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": used, "n": total.ravel()[used]})

    size = _WORDS + len(known.value)
    rows = parts.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((2, 2 * size + DENSE * DENSE), dtype=np.int64)
    total.ravel()[rows["place"].to_numpy()] = rows["n"].to_numpy()
    return [(sums[: 2 * size].reshape(2, size), sums[2 * size :].reshape(DENSE, DENSE)) for sums in total]


class Model:
    """Unigrams, contexts and dense bigrams of one corpus, with the losses of bigram counts.
    `different` is the number of words that a unigram probability is shared by."""

    def __init__(self, singles: np.ndarray, dense: np.ndarray, prior: float, different: int):
        self.context = singles[0].astype(float)
        self.total = singles[1].sum() + different
        self.word = (singles[1] + 1.0) / self.total
        self.dense, self.prior = dense, prior

    def loss(self, before: np.ndarray, word: np.ndarray, count: np.ndarray) -> np.ndarray:
        return -np.log((count + self.prior * self.word[word]) / (self.context[before] + self.prior))

    def open_loss(self, before: np.ndarray, word: np.ndarray, count: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Of codes; `single` is the unigram count of hashed words. A bigram with a hashed context
        has its denominator from the entry of that context, whose word is _CONTEXT."""
        chance = np.where(word < _HASHED, self.word[_ids(word)], (single + 1.0) / self.total)
        under = np.where(before < _HASHED, np.log(self.context[_ids(before)] + self.prior), 0.0)
        of_context = (before >= _HASHED) & (word == _CONTEXT)
        return np.where(of_context, np.log(count + self.prior), under - np.log(count + self.prior * chance))


def _planes(values: np.ndarray) -> bytes:
    """64-bit integers as their first bytes, then their second ones and so on: alike bytes compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _of_planes(raw: bytes, n: int, at: int, kind: str) -> np.ndarray:
    """n integers of `_planes`, behind `at` others."""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 8 * at).reshape(8, n).T).view(kind).ravel()


class Asked:
    """The different bigrams of some texts that are not in the dense tables of `dense` ids, and
    what texts they are in. Each is listed by its word or, where its context alone is hashed, by
    that: the head; they are in the order of buckets, heads and what is beside the head. A hashed
    context has an entry of its own, once for each time that it is one."""

    def __init__(self, before: np.ndarray, word: np.ndarray, row: np.ndarray, dense: int, n_buckets: int):
        rest = (before >= dense) | (word >= dense)
        before, word, row = before[rest], word[rest], row[rest]
        hashed = before >= _HASHED
        before = np.concatenate([before, before[hashed]])
        word = np.concatenate([word, np.full(int(hashed.sum()), _CONTEXT)])
        row = np.concatenate([row, row[hashed]])
        by_context = (before >= _HASHED) & (word < _HASHED)
        head, beside = np.where(by_context, before, word), np.where(by_context, word | _AFTER, before)
        # all of a hashed head meets in its bucket, bigrams of two ids are spread by context too
        key = mix(np.where(head < _HASHED, before ^ word * _U(0x9E3779B97F4A7C15), head))
        bucket = ((key >> _U(20)) % _U(n_buckets)).astype(np.int64)
        order = np.lexsort((beside, head, bucket))
        head, beside, bucket = head[order], beside[order], bucket[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (head[1:] != head[:-1]) | (beside[1:] != beside[:-1])
        begin = np.flatnonzero(new)
        self.row, self.entry = row[order], np.cumsum(new) - 1
        self.before, self.word = before[order][begin], word[order][begin]
        self.head, self.beside, self.bucket = head[begin], beside[begin], bucket[begin]

    def packets(self, packer: zstandard.ZstdCompressor, shares: tuple[np.ndarray, ...]) -> Iterator[tuple[int, bytes, int]]:
        """Bucket, packed entries and their number; counts are of the rows of each share."""
        counts = [np.bincount(self.entry[share[self.row]], minlength=len(self.head)) for share in shares]
        bounds = np.flatnonzero(np.append(np.append(True, self.bucket[1:] != self.bucket[:-1]), True)) if len(self.bucket) else []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            head = self.head[a:b]
            first = np.flatnonzero(np.append(True, head[1:] != head[:-1]))
            parts = (
                np.array([len(first)]), np.diff(head[first], prepend=_U(0)), np.diff(np.append(first, b - a)), self.beside[a:b],
                *(n[a:b].astype(np.int64) for n in counts))
            yield int(self.bucket[a]), packer.compress(b"".join(map(_planes, parts))), int(b - a)


def _entries(raw: bytes, n: int) -> tuple[np.ndarray, ...]:
    """Heads, what is beside them, and the two counts of the entries of a packet."""
    heads = int(_of_planes(raw, 1, 0, "<i8")[0])
    head = np.repeat(np.cumsum(_of_planes(raw, heads, 1, "<u8"), dtype=_U), _of_planes(raw, heads, 1 + heads, "<i8"))
    at = 1 + 2 * heads
    return head, _of_planes(raw, n, at, "<u8"), _of_planes(raw, n, at + n, "<i8"), _of_planes(raw, n, at + 2 * n, "<i8")


def _rows(columns: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(columns.values())], names=list(columns))


def _chunked(table: DataFrame) -> DataFrame:
    """Rows (doc_id, text) as chunks: chunk, ids, lengths of the texts in bytes (-1: null), packed texts."""
    field = table.schema["doc_id"]
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(field.dataType)), T.StructField("lengths", T.BinaryType()),
        T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, part in chunks(batch.column(1), CHUNK_BYTES):
                raw = [None if t is None else t.encode() for t in part.to_pylist()]
                lengths = np.array([-1 if t is None else len(t) for t in raw], dtype=np.int64)
                ids = batch.column(0).slice(at, len(part))
                listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids]))
                packed = packer.compress(b"".join(t for t in raw if t is not None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), listed, pa.array([lengths.tobytes()]), pa.array([packed])], names=schema.names)
                number += 1

    return table.mapInArrow(run, schema)


def _words_of(lengths: bytes, packed: bytes) -> Words:
    size = np.maximum(np.frombuffer(lengths, np.int64), 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(offsets[-1])) if offsets[-1] else b""
    return cut_bytes(np.frombuffer(raw, np.uint8), offsets)


def _shares(batch: pa.RecordBatch) -> Iterator[tuple[int, Words, tuple[np.ndarray, np.ndarray]]]:
    """Each chunk with its words and which of its rows are the target's and the background's."""
    for i in range(batch.num_rows):
        chunk, lengths, packed, chosen = (c[i].as_py() for c in batch.columns)
        words = _words_of(lengths, packed)
        background = np.full(len(words.first) - 1, chunk != _TARGET)
        target = ~background
        target[chosen or []] = True
        yield chunk, words, (target, background)


_SENT = {"bucket": pa.int64(), "chunk": pa.int64(), "packed": pa.binary(), "n": pa.int64()}
_COUNTED = {"chunk": pa.int64(), "bucket": pa.int64(), "packed": pa.binary(), "n": pa.int64()}
_TARGET = -1  # in place of a chunk: texts that are the target's alone and get no answer


def _settle(part: pa.Table) -> pa.Table:
    """Adds up the entries of a bucket; for each packet of a chunk the target's and background's
    counts of its bigrams and, for hashed words, of the words."""
    unpacker, packer, cols = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1), []
    size, chunk = part.column("n").to_numpy(), part.column("chunk").to_numpy()
    for packed, n in zip(part.column("packed"), size.tolist(), strict=True):
        cols.append(_entries(unpacker.decompress(packed.as_py()), n))
    head, beside, *added = (np.concatenate(c) for c in zip(*cols, strict=True))
    cols.clear()
    order = np.lexsort((beside, head))
    head, beside = head[order], beside[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (head[1:] != head[:-1]) | (beside[1:] != beside[:-1])
    begin = np.flatnonzero(new)
    entry = np.empty(len(order), dtype=np.int64)
    entry[order] = np.cumsum(new) - 1
    head, beside = head[begin], beside[begin]
    first = np.flatnonzero(np.append(True, head[1:] != head[:-1]))
    of_head = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(head))))
    is_word, counts = (head >= _HASHED) & ((beside < _AFTER) | (beside >= _HASHED)), []
    for count in added:
        n = np.bincount(entry, count, minlength=len(head)).astype(np.int64)
        counts += [n, np.where(is_word, np.add.reduceat(np.where(is_word, n, 0), first)[of_head], 0)]
    bucket, out, at = part.column("bucket")[0].as_py(), [], 0
    for n, to in zip(size.tolist(), chunk.tolist(), strict=True):
        if to != _TARGET:
            out.append((to, bucket, packer.compress(b"".join(_planes(c[entry[at : at + n]]) for c in counts)), n))
        at += n
    return pa.Table.from_batches([_rows(_COUNTED, out)])


def score(background: DataFrame, target: DataFrame, keep, prior: float = PRIOR) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss (means per token) and score of all rows
    (doc_id, text) of `background`. `target` has texts (text) or, as its only column, the ids
    (doc_id) of the rows of `background` that are the target.
    """
    context = background.sparkSession.sparkContext
    texts = background.select("doc_id", F.col("text").cast("string").alias("text"))
    words, different = _all_words(texts.select("text"), keep)
    known = context.broadcast(words)
    cut_up = keep(_chunked(texts), "chunks")
    parts = cut_up.select("chunk", "lengths", "packed")
    if target.columns == ["doc_id"]:
        # ids meet ids; a chunk then has a list of places, at most one for each of its rows
        places = cut_up.select("chunk", F.posexplode("ids").alias("place", "doc_id")).join(target, "doc_id", "left_semi")
        chosen = keep(places.groupBy("chunk").agg(F.collect_list("place").alias("chosen")), "chosen")
        parts = parts.join(chosen, "chunk", "left").select(*parts.columns, "chosen")
    else:
        alone = target.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        alone = keep(_chunked(alone), "target").select(F.lit(_TARGET).cast("long").alias("chunk"), "lengths", "packed")
        parts = parts.unionByName(alone).withColumn("chosen", F.lit(None).cast("array<int>"))
    models = context.broadcast([Model(*counted, prior, _WORDS + different) for counted in _dense_counts(parts, known)])
    # words, and once more those that are hashed contexts
    entries = int(models.value[1].context.sum() + models.value[1].context[_UNKNOWN])
    n_buckets, dense = max(1, -(-entries // BUCKET_ENTRIES)), DENSE

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = Ids(known.value), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for chunk, words, shares in _shares(batch):
                asked = Asked(*ids.bigrams(words), dense, n_buckets)
                yield _rows(_SENT, [(bucket, chunk, raw, n) for bucket, raw, n in asked.packets(packer, shares)])

    schema = T.StructType([texts.schema["doc_id"], *T.StructType.fromDDL(
        "n_tokens long, target_loss double, background_loss double, score double").fields])

    def finish(held: pa.Table, counted: pa.Table) -> pa.Table:
        out, unpacker = [], zstandard.ZstdDecompressor()
        for row, (lengths, packed) in enumerate(zip(held.column("lengths").to_pylist(), held.column("packed").to_pylist(), strict=True)):
            words = _words_of(lengths, packed)
            before, word, of = Ids(known.value).bigrams(words)
            both, size = (before < dense) & (word < dense), len(words.first) - 1
            b, w, asked = _ids(before[both]), _ids(word[both]), Asked(before, word, of, dense, n_buckets)
            answers = []
            for i in np.argsort(counted.column("bucket").to_numpy()):
                n = counted.column("n")[int(i)].as_py()
                raw = unpacker.decompress(counted.column("packed")[int(i)].as_py())
                answers.append(np.stack([_of_planes(raw, n, k * n, "<i8") for k in range(4)]))
            counts = np.concatenate(answers, axis=1) if answers else np.zeros((4, 0), np.int64)
            n, means = np.bincount(of, minlength=size), []
            for m, (count, single) in zip(models.value, (counts[:2], counts[2:]), strict=True):
                loss = m.open_loss(asked.before, asked.word, count, single)
                total = np.bincount(of[both], m.loss(b, w, m.dense[b, w]), minlength=size) + np.bincount(asked.row, loss[asked.entry], minlength=size)
                means.append(total / np.maximum(n, 1))
            none = n == 0
            columns = [pa.array(n.astype(np.int64)), *(pa.array(x, mask=none) for x in (*means, means[0] - means[1]))]
            out.append(pa.Table.from_arrays([held.column("ids").combine_chunks()[row].values, *columns], names=schema.names))
        return pa.concat_tables(out)

    sent = parts.mapInArrow(ask, "bucket long, chunk long, packed binary, n long")
    counted = sent.groupBy("bucket").applyInArrow(_settle, "chunk long, bucket long, packed binary, n long")
    return cut_up.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(finish, schema)
