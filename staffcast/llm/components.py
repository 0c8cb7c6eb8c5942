"""Connected components of a table of links by alternating star contractions.

Every round replaces links by links to least neighbours with groupings and joins on the
linked ids, so a node with very many links is a sum formed before the shuffle and a skewed
join that adaptive execution splits; nothing is gathered in one task or on the driver.
Rounds grow with the logarithm of the longest path. Each round's links are written, and
rounds end when a checksum of them stays the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _to_least(links: DataFrame, both: bool) -> DataFrame:
    """Links (a, b), a > b. Large stars (`both`): larger neighbours go to the least one of all;
    small stars: a node and its smaller neighbours go to the least of these."""
    ways = links.union(links.select("b", "a")) if both else links
    least = ways.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = ways.join(least, "a")
    if both:
        moved = joined.filter("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    else:
        moved = joined.select(F.col("b").alias("x"), F.col("m").alias("y")).union(least.select("a", "m"))
    return moved.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(links: DataFrame, keep) -> DataFrame:
    """Of links (a, b) between ids: each linked id as `node` and the least id it reaches as `least`."""
    now = keep(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        now = keep(_to_least(keep(_to_least(now, True), "large"), False), "small")
    return now.select(F.col("a").alias("node"), F.col("b").alias("least")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct())
