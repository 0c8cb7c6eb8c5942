"""A corpus from raw documents to tokens: each stage is written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from staffcast.llm import bpe, metric_join, mixing, ordinal, superkmers
from staffcast.llm.stages import Kept, prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents whose probability of the best grade is too low go.

    The model is fitted on a bounded sample of the rated documents. Without any ratings it
    knows nothing, and all documents stay.
    """
    prepare(spark)
    model = ordinal.train(docs, ordinal.graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    if not model.weights.any():
        return docs
    return ordinal.grade(docs, model).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near copies the document with the smallest id stays.

    Of rows that repeat an id one stays; documents without an id stay.
    """
    prepare(spark)
    found = metric_join.join_components(docs, Kept(spark))
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    if docs.groupBy("doc_id").count().filter("doc_id IS NOT NULL AND count > 1").take(1):
        known = left.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
        left = known.unionByName(left.filter("doc_id IS NULL"))
    return left.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: words of repeated passages go; a text without any stays as it is."""
    prepare(spark)
    found = superkmers.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    out = found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: each document as often as the mix takes it."""
    prepare(spark)
    keep = Kept(spark)
    taken = mixing.mix(keep, docs).filter("repeats > 0").groupBy("doc_id").agg(F.max("repeats").alias("repeats"))
    taken = keep(taken.select(F.col("doc_id").alias("taken_id"), "repeats"), "taken")
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(taken["taken_id"]))
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))
    return joined.select(*[docs[c] for c in docs.columns], times.alias("time")).drop("time")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: the packed ids of each document, and whether they decode to its text.

    One worker a task takes both steps; as two Python steps they would hold two, and workers live on.
    """
    prepare(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    back = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return back.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

#: A fitted model and BPE can't be written in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and reread."""
    keep = Kept(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
