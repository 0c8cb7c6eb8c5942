"""Quality classifier: cumulative-link (ordinal) regression on graded ratings.

One weight vector over hashed text features gives every text a strength s; ordered thresholds
t_0 < t_1 < ... cut it into grades: P(grade <= k) = sigmoid(t_k - s). From that follow the
expected grade and the tail probability P(grade >= k), by which documents are selected: one is
rejected when its features halve the odds of a good grade that all rated texts have. A text
without known features is at those odds and stays; there must be evidence against it.

Features are present or absent: the lower-cased words, the beginnings of longer words, of
four and six bytes, and coarse shapes of the text (shares of capitals, symbols, digits, non-ASCII bytes
and different words, and the mean word length). Weights have a fixed number, 2 ** BITS, so
what is broadcast doesn't grow. The model is fitted on at most SAMPLE_ROWS rated ids, those
of least hash, each with one text. Which features stand apart by grade is found in Spark, and
only those of the sample's texts come to the driver; scoring covers all documents without a
shuffle.

Defined results: a null or empty text has only shape features and gets a grade like any
other; ratings with a null part are left out; of rows that repeat a rated id the greatest text
is fitted; repeated rows score alike; without ratings all grades are equally likely; an empty
table gives an empty result; all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from staffcast.llm.stages import Kept
from staffcast.llm.words import Words, chunks, cut, hashes, mix

BITS = 18
SAMPLE_ROWS = 16384  # bound of the rated sample that the model is fitted on
STEM_BYTES = (4, 6)
EVIDENCE = 2.0  # a text is rejected whose odds of a good grade are lower by this factor than the rated texts'
LEAST_DOCS = 8  # of the sample, for a feature to have a weight
LEAST_ERRORS = 4.0  # standard errors by which its share of some grades must stand apart
_U = np.uint64
_CAPITAL, _LETTER, _DIGIT, _SYMBOL, _FOREIGN, _BLANK = range(6)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _SYMBOL, dtype=np.uint8)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[128:] = _CAPITAL, _LETTER, _DIGIT, _FOREIGN
    kinds[[0x20, *range(0x09, 0x0E)]] = _BLANK
    return kinds


_KINDS = _byte_kinds()


def _stems(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words are longer than a stem, and hashes of their first bytes."""
    longer = words.end - words.start > size
    cut_short = words._replace(start=words.start[longer], end=words.start[longer] + size)
    return longer, hashes(cut_short, lower=True) ^ _U(size)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Different feature numbers of every text, one text after the other, and where each begins."""
    words = cut(texts)
    row, n = words.rows(), len(texts)
    h = hashes(words, lower=True)
    stems = [_stems(words, size) for size in STEM_BYTES]
    # shapes: per text the share of each kind of byte and the like, in coarse steps
    lengths = words.end - words.start
    text_bytes = np.bincount(row, lengths, minlength=n)
    inside = np.zeros(len(words.data) + 1, dtype=np.int64)
    shapes = []
    kind = _KINDS[words.data]
    for k in (_CAPITAL, _DIGIT, _SYMBOL, _FOREIGN):
        np.cumsum(kind == k, out=inside[1:])
        shapes.append(np.bincount(row, inside[words.end] - inside[words.start], minlength=n) / np.maximum(1, text_bytes))
    order = np.lexsort((h, row))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    different = np.bincount(row[order][new], minlength=n)
    counts = np.maximum(1, words.counts)
    shapes.append(different / counts)
    shapes.append(text_bytes / counts / 25)
    steps = np.stack([np.ceil(12 * np.sqrt(np.clip(s, 0, 1))).astype(np.int64) for s in shapes])
    shape = np.stack([mix(steps[k].astype(_U) + _U(1000 * (k + 1))) for k in range(len(steps))]).ravel()
    keep = order[new]
    value = np.concatenate([h[keep], *(found for _, found in stems), shape])
    owner = np.concatenate([row[keep], *(row[longer] for longer, _ in stems), np.tile(np.arange(n), len(steps))])
    number = (mix(value) >> _U(64 - BITS)).astype(np.int64)
    both = np.unique(owner << BITS | number)
    return both & ((1 << BITS) - 1), np.searchsorted(both >> BITS, np.arange(n + 1))


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    base: np.ndarray  # P(grade <= k) of the rated texts, for every k but the last

    def strengths(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[number])])
        return sums[first[1:]] - sums[first[:-1]]

    def at_most(self, strengths: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every text (rows) and every k but the last."""
        return 1 / (1 + np.exp(np.clip(strengths[:, None] - self.thresholds, -500, 500)))

    def least_tail(self, grade: int, evidence: float) -> float:
        """The tail probability of `grade` below which the odds are `evidence` times lower than the base's."""
        odds = (1 - self.base[grade - 1]) / self.base[grade - 1] / evidence
        return odds / (1 + odds)


def _base(counts: np.ndarray) -> np.ndarray:
    """Shares of rated texts up to each grade but the last, one more counted in every grade."""
    return np.cumsum(counts + 1.0)[:-1] / (counts.sum() + len(counts))


def fit(number: np.ndarray, first: np.ndarray, grades: np.ndarray, n_grades: int, rounds: int = 200, ridge: float = 1e-4, rate: float = 0.05) -> Model:
    """Maximum likelihood with a ridge on the weights, by Adam on all rows at once. Row r has the
    features number[first[r] : first[r + 1]]; all others keep weight 0. Thresholds are a first
    one and the exponentials of positive steps, so they stay ordered.
    """
    m, size, each = len(grades), 1 << BITS, np.arange(len(grades))
    base = _base(np.bincount(grades, minlength=n_grades))
    begin = np.log(base / (1 - base))
    if not m:
        return Model(np.zeros(size), begin, base)
    # only features in use are fitted
    used, number = np.unique(number, return_inverse=True)
    k, row = len(used), np.repeat(each, np.diff(first))
    free = np.concatenate([np.zeros(k), begin[:1], np.log(np.maximum(np.diff(begin), 1e-3))])
    mean, square = np.zeros_like(free), np.zeros_like(free)

    def cuts() -> np.ndarray:
        return np.concatenate([[free[k]], free[k] + np.cumsum(np.exp(free[k + 1 :]))])

    for step in range(1, rounds + 1):
        model = Model(free[:k], cuts(), base)
        upto = model.at_most(model.strengths(number, first))
        upto = np.concatenate([np.zeros((m, 1)), upto, np.ones((m, 1))], axis=1)
        low, high = upto[each, grades], upto[each, grades + 1]
        p = np.maximum(high - low, 1e-12)
        # derivatives of the two cumulative probabilities by their thresholds
        d_low, d_high = low * (1 - low), high * (1 - high)
        by_strength = (d_high - d_low) / p / m
        gradient = np.zeros_like(free)
        gradient[:k] = np.bincount(number, by_strength[row], minlength=k) + ridge * free[:k]
        by_cut = np.zeros((m, n_grades + 1))
        by_cut[each, grades + 1] -= d_high / p / m
        by_cut[each, grades] += d_low / p / m
        by_cut = by_cut.sum(axis=0)[1:-1]
        gradient[k] = by_cut.sum()
        gradient[k + 1 :] = np.exp(free[k + 1 :]) * np.cumsum(by_cut[::-1])[::-1][1:]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        free = free - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(size)
    weights[used] = free[:k]
    return Model(weights, cuts(), base)


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and grade from labels quality and toxic: one point for quality, one for not toxic."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return known.groupBy("doc_id").agg(F.min(F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade"))


def _featured(rows: DataFrame) -> DataFrame:
    """(doc_id, grade, number) of rows (doc_id, grade, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(2)):
                number, first = features(texts)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(number.astype(np.int32)))
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], names=["doc_id", "grade", "number"])

    return rows.mapInArrow(run, "doc_id long, grade int, number array<int>")


def telling(rows: DataFrame, counts: np.ndarray, least_docs: int, least_errors: float) -> np.ndarray:
    """Features (of rows with `number` and `grade`, counted by grade in `counts`) of at least
    `least_docs` rows whose share of rows up to some grade is more than `least_errors` standard
    errors from all rows' share. Tasks add up counts of a fixed number of features."""
    n_grades = len(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_grades, 1 << BITS), dtype=np.int64)
        for batch in batches:
            lists, grade = batch.column(1), batch.column(0).to_numpy()
            of = np.repeat(grade, np.asarray(pa.compute.list_value_length(lists)))
            number = lists.flatten().to_numpy()
            for g in range(n_grades):
                total[g] += np.bincount(number[of == g], minlength=1 << BITS)
        seen = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), *(pa.array(t[seen]) for t in total)], names=["feature", *(f"g{g}" for g in range(n_grades))])

    schema = ", ".join(["feature long", *(f"g{g} long" for g in range(n_grades))])
    sums = rows.select("grade", "number").mapInArrow(run, schema).groupBy("feature").agg(*[F.sum(f"g{g}").alias(f"g{g}") for g in range(n_grades)])
    docs, apart, below = sum(F.col(f"g{g}") for g in range(n_grades)), F.lit(False), F.lit(0)
    for g in range(n_grades - 1):
        share = float(counts[: g + 1].sum() / max(1, counts.sum()))
        below = below + F.col(f"g{g}")
        apart = apart | (F.abs(below - share * docs) > least_errors * ((share * (1 - share)) ** 0.5 + 1e-9) * F.sqrt(docs))
    return np.sort(sums.filter(apart & (docs >= least_docs)).select("feature").toPandas()["feature"].to_numpy(dtype=np.int64))


def train(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, sample_rows: int = SAMPLE_ROWS, keep=None,
          least_docs: int = LEAST_DOCS, least_errors: float = LEAST_ERRORS) -> Model:
    """Fits on (doc_id, text) and (doc_id, grade). The sample of ratings is bounded by
    `sample_rows`, so it is broadcast; of its texts' features only those that tell grades apart
    come back."""
    keep = keep or Kept(docs.sparkSession)
    sample = ratings.groupBy("doc_id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = sample.withColumn("grade", F.least(F.greatest("grade", F.lit(0)), F.lit(n_grades - 1)))
    chosen = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("grade").alias("grade"), F.max(F.col("text").cast("string")).alias("text"))
    rows = keep(_featured(chosen), "features")
    found = {r.grade: r["count"] for r in rows.groupBy("grade").count().collect()}
    counts = np.array([found.get(g, 0) for g in range(n_grades)], dtype=np.int64)
    if not counts.sum():
        return fit(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), n_grades)
    known = docs.sparkSession.sparkContext.broadcast(telling(rows, counts, least_docs, least_errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros(1 << BITS, dtype=bool)
        told[known.value] = True
        for batch in batches:
            lists = batch.column(2)
            number, length = lists.flatten().to_numpy(), np.asarray(pa.compute.list_value_length(lists))
            row = np.repeat(np.arange(len(lists)), length)
            first = np.concatenate([[0], np.cumsum(np.bincount(row[told[number]], minlength=len(lists)))])
            kept = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(number[told[number]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kept], names=["doc_id", "grade", "number"])

    fitted = rows.mapInArrow(run, "doc_id long, grade int, number array<int>").toArrow().combine_chunks()
    fitted = fitted.sort_by([("doc_id", "ascending")])  # sums of floats in one order, so reruns agree
    lists = fitted.column("number").combine_chunks()
    first = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return fit(lists.flatten().to_numpy(), first, fitted.column("grade").to_numpy().astype(np.int64), n_grades)


def grade(docs: DataFrame, model: Model, least_grade: int = 2, evidence: float = EVIDENCE) -> DataFrame:
    """Adds expected_grade, tail_probability, that is P(grade >= least_grade), and kept: whether its
    odds are more than the rated texts' odds over `evidence`."""
    added = {"expected_grade": "double", "tail_probability": "double", "kept": "boolean"}
    own = [c for c in docs.columns if c not in added]
    text_at = own.index("text")
    schema = docs.select(*[F.col(f"`{c}`") for c in own], *[F.lit(None).cast(k).alias(c) for c, k in added.items()]).schema
    sent = docs.sparkSession.sparkContext.broadcast(model)
    least = model.least_tail(least_grade, evidence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(text_at).cast(pa.string())):
                upto = sent.value.at_most(sent.value.strengths(*features(texts)))
                expected = (1 - upto).sum(axis=1)
                tail = 1 - upto[:, least_grade - 1]
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(expected), pa.array(tail), pa.array(tail > least)], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in own]).mapInArrow(run, schema)
