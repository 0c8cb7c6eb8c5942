"""Mixing sources to target weights by capped water-filling, then seeded repetitions.

Targets: the wanted total is shared by weight; a source whose share exceeds `max_epochs`
times its size is clamped there and the excess is shared again by weight among the others,
until none is above. The fixed point is target = min(cap, level * weight) with one level for
all, found in one pass over the sources ordered by cap / weight.

Repetitions: a source with target / size = whole + part takes each of its documents `whole`
times, and `part` of them once more. Those are picked systematically from the documents in
order of size and then of a seeded hash, so the words taken differ from the target by less
than about one longest document, whatever the number of documents.

Defined results: a null text has size 0; a null source is one source of its own, last in
order; sources without words get target 0; repeated rows are mixed like different ones; rows
with equal ids and sizes may swap places, which changes no row of the result; an empty table
gives an empty result; other columns of the documents are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from staffcast.llm.words import WORD

GROUP_ROWS = 4096
_HEX = 8  # digits of the hash that order the groups of documents with one size


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source and size, the number of words."""
    words = F.regexp_count(F.col(text_col), F.lit(WORD))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
    )


def weigh(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weights repeat over the sources in code point order, a null source last. One row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Adds `target` to rows (source, source_size, weight); their targets add up to `share` of all
    sizes, or to all caps if that is less."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1))
    left = (
        sources
        .withColumn("left", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        .withColumn("weights_left", F.sum("weight").over(after))
    )
    # the level at which this row is the first that isn't clamped; clamped rows come before all others
    fits = F.col("left") * F.col("weight") <= cap * F.col("weights_left")
    open_now = F.max(F.when(fits, F.lit(1)).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    first = F.struct(F.col("left"), F.col("weights_left"))
    level = F.first(F.when(fits, first), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return left.select(
        "source", "source_size", "weight",
        F.when(open_now == 1, level["left"] * F.col("weight") / level["weights_left"]).otherwise(cap).alias("target"),
    )


def _draw(seed: int, what: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), what))


def _unit(digest: Column) -> Column:
    """The first hexadecimal digits as a number from 0 up to 1."""
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("long") / F.lit(float(16**_HEX))


def mix(
    spark_keep,
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, repeats, taken.

    `spark_keep` writes a table between stages (stages.Kept). Ranks within a source come from
    counts per (source, size, hash group) added up in order, so no task sorts a whole source:
    a group has about GROUP_ROWS documents, however many share a source or a size.
    """
    rows = spark_keep(sizes(docs), "sizes")
    by_size = spark_keep(rows.groupBy("source", "size").count(), "by-size")
    sources = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"))
    targets = spark_keep(water_fill(weigh(sources, weights), share, max_epochs), "targets")

    def same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
        on = F.lit(True)
        for k in keys:
            on = on & left[k].eqNullSafe(right[k])
        return on

    sizes_known = by_size.withColumnRenamed("count", "alike")
    drawn = rows.join(sizes_known, same(rows, sizes_known, "source", "size")).select(
        rows["doc_id"], rows["source"], rows["size"],
        _draw(seed, F.coalesce(rows["doc_id"].cast("string"), F.lit("null"))).alias("draw"), "alike",
    ).withColumn("part", F.floor(_unit(F.col("draw")) * F.ceil(F.col("alike") / GROUP_ROWS)))
    drawn = spark_keep(drawn.drop("alike"), "drawn")
    groups = drawn.groupBy("source", "size", "part").count()
    before = Window.partitionBy("source").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1)
    groups = spark_keep(
        groups.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"), "groups")

    ranked = drawn.withColumn(
        "within", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("draw", "doc_id")))
    placed = ranked.join(groups, same(ranked, groups, "source", "size", "part")).select(
        ranked["doc_id"], ranked["source"], ranked["size"], (groups["before"] + ranked["within"]).alias("rank"))
    joined = placed.join(targets, same(placed, targets, "source"))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _unit(_draw(seed, F.concat(F.lit("source:"), F.coalesce(placed["source"], F.lit("")))))
    return joined.select(
        placed["doc_id"], placed["source"], placed["size"], "source_size", "target", "rank",
        F.floor(epochs).alias("whole"), (epochs - F.floor(epochs)).alias("fraction"), offset.alias("offset"),
    ).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") + F.floor(F.col("fraction") * F.col("rank") + F.col("offset"))
         - F.floor(F.col("fraction") * (F.col("rank") - 1) + F.col("offset"))).cast("long").alias("repeats"),
    ).withColumn("taken", F.col("repeats") * F.col("size"))
