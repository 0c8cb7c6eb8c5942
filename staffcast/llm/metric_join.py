"""Exact n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric, but unrelated texts are all at distance 1, where the triangle
inequality separates nothing. So the join goes from coarse to fine, and every step is exact:

1. Texts with equal sets form one class. The least third of each set is compared with the
   least thirds of all others. How many hits a linked set must have there (`least_hits`) counts
   what may be missing from its own part and what the other set's surplus may push out of that
   set's part; the sets with fewer are apart from all others.
2. The remaining sets are ordered by how many sets hold a shingle. Linked sets share one of
   the rarest fifth of their shingles, so the sets that share such a shingle are a first region,
   in which no two sets are at distance 1, and linked sets meet in one.
3. A region of too many sets is split into the Voronoi cells of pivots drawn from it. A set
   belongs to the cell of its nearest pivot if that is within RADIUS thresholds. By the triangle
   inequality a set linked to a set of a cell is within one threshold more of that pivot, and
   has at most two thresholds more to it than to its own, so boundary sets are replicated to the
   cells within that window. The sets that no pivot is near are a cell of their own. Cells are
   regions of the next level, and are split again while they are too large. A set in the ball of
   its pivot is linked to it; sets that are so known to be connected have one label and need no
   further comparison, and a cell of one label is done.
4. Where cells don't get smaller, since the region is as narrow as the window, the sets outside
   the most frequent label are compared with all of the region, in blocks.
5. A region that is small enough is joined in one task. Two sets whose distances to any pivot
   differ by more than the threshold are never compared there, and a set becomes a pivot only
   while some set of another component is inside its windows.

The links kept connect exactly the texts that links connect; pairs of one label are not listed.

Defined results: a null text or one without words has an empty set and links with nothing;
repeated rows and equal texts form one class; rows with one id but different texts are told
apart; a null id never names a component that has other ids; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staffcast.llm import shingles
from staffcast.llm.components import components
from staffcast.llm.packing import packed, unpacked
from staffcast.llm.words import chunks

SHINGLE = 5
PERCENT = 80
REGION_SETS = 1500  # more are split
REGION_VALUES = 1 << 21
PIVOTS = 16  # of a region, and distances that a small region's join remembers
RADIUS = 2  # of a cell, in thresholds
LEAST_SHRINK = 0.9  # of a region's sets, in its largest cell, for a split to go on
_SLACK = 1e-9
_PROFILE = "doc_id long, n int, k1 long, k2 long, need int, part binary"


def least_hits(n: np.ndarray, percent: int) -> np.ndarray:
    """How many values the part of a set of size `n` has, at least, in the part of any linked set.

    With c values in common the part of size p(n) lacks at most n - c of them, and the part of
    the other set, of size m, at most m - c; both hold the least common values, so they share at
    least min(p(n) - (n - c), p(m) - (m - c)). The first is least for a subset, m = percent of n.
    The second is at least one more than the whole part of a linear function of m, so it is
    bounded at both ends of the sizes that link. One shared value is always certain.
    """
    missing = 100 - percent
    own = np.minimum(n, n * missing * 3 // 200 + 1) - n * missing // 100
    superset = n * missing // (2 * percent) + 1
    subset = n * missing * percent * 3 // 20000 + 1
    return np.maximum(1, np.minimum(own, np.minimum(superset, subset)))


def profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, set size, two hashes of the set, the hits it needs to link, and the least part of
    it, packed: a half more than the `100 - percent` percent that may be missing from a linked set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(1)):
                values, first = shingles.sets(texts, width)
                n = np.diff(first)
                k1, k2 = shingles.set_keys(values, first)
                size = np.minimum(n, n * (100 - percent) * 3 // 200 + 1)
                part = values[shingles.ranges(first[:-1], size)]
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32) * 8
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(n)), pa.array(n.astype(np.int32)), pa.array(k1), pa.array(k2),
                     pa.array(least_hits(n, percent).astype(np.int32)), packed],
                    names=["doc_id", "n", "k1", "k2", "need", "part"])

    return docs.mapInArrow(run, _PROFILE)


def _packed_reader(owner: int, column: int):
    """Reads (owner, packed 64-bit hashes) from batches, a slice of about two megabytes at a time."""

    def read(batch: pa.RecordBatch):
        for at, part in chunks(batch.column(column)):
            ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
            raw = np.frombuffer(part.buffers()[2], np.uint8)[ends[0] : ends[-1]] if part.buffers()[2] is not None else np.zeros(0, np.uint8)
            values = raw.copy().view(np.uint64)
            row = np.repeat(np.arange(len(part)), np.diff(ends) // 8)
            yield values, row, batch.column(owner).slice(at, len(part)).to_numpy()

    return read


def _whole_sets(rows: DataFrame, width: int) -> DataFrame:
    """Of rows (node, k1, k2, compressed text) the node, size and packed set of those whose text has these hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in unpacked(batch.column(3)):
                values, first = shingles.sets(texts, width)
                k1, k2 = shingles.set_keys(values, first)
                want = batch.slice(at, len(texts))
                ok = (want.column(1).to_numpy() == k1) & (want.column(2).to_numpy() == k2)
                n = np.diff(first)[ok]
                part = values[shingles.ranges(first[:-1][ok], n)]
                ends = (np.concatenate([[0], np.cumsum(n)]) * 8).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(want.column(0).to_numpy()[ok]), pa.array(n.astype(np.int32)), packed], names=["node", "n", "set"])

    return rows.mapInArrow(run, "node long, n int, set binary")


def _rarest(shared: DataFrame, percent: int) -> DataFrame:
    """(node, value): the rarest shingles of every set of which enough is shared, one more than
    may be missing. Shingles in no other set are the rarest and need no region."""

    def pick(part: pa.Table) -> pa.Table:
        value, node, total = shingles.answers(part)
        nodes, index = np.unique(node, return_inverse=True)
        size = total < 0
        n = -np.bincount(index[size], total[size], minlength=len(nodes)).astype(np.int64)
        value, index, total = value[~size], index[~size], total[~size]
        take = n * (100 - percent) // 100 + 1 - (n - np.bincount(index, minlength=len(nodes)))
        order = np.lexsort((value, total, index))
        value, index = value[order], index[order]
        keep = np.arange(len(index)) - np.searchsorted(index, index) < take[index]
        return pa.table({"node": nodes[index[keep]].astype(np.int64), "value": value[keep].view(np.int64)})

    return shared.groupBy("group").applyInArrow(pick, "node long, value long")


class Sets:
    """Some sets with an index from shingles to the sets that hold them."""

    def __init__(self, packed: list[bytes]):
        self.n = np.array([len(p) // 8 for p in packed], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        self.values = np.frombuffer(b"".join(packed), np.uint64)
        owner = np.repeat(np.arange(len(packed)), self.n)
        order = np.argsort(self.values, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = self.values[order][1:] != self.values[order][:-1]
        self.begin = np.flatnonzero(new)
        self.size = np.diff(np.append(self.begin, len(order)))
        self.keys, self.holders = self.values[order][new], owner[order]

    def shared_with(self, values: np.ndarray) -> np.ndarray:
        """For every set the number of its shingles among `values`."""
        at = np.minimum(np.searchsorted(self.keys, values), max(0, len(self.keys) - 1))
        at = at[self.keys[at] == values] if len(self.keys) else at[:0]
        return np.bincount(self.holders[shingles.ranges(self.begin[at], self.size[at])], minlength=len(self.n))

    def of(self, i: int) -> np.ndarray:
        return self.values[self.first[i] : self.first[i + 1]]


def _linked(shared: np.ndarray, n: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    return (100 * shared >= percent * (n + sizes - shared)) & (shared > 0)


def connect(packed: list[bytes], labels: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of places of linked sets that connect exactly what all links connect, sets of one
    label being connected already.

    A set is made a pivot, that is compared with all, only while a set of another component that
    was no pivot yet is within the threshold by the triangle inequality over the pivots so far.
    """
    sets = Sets(packed)
    m, limit = len(packed), 1 - percent / 100 + _SLACK
    component, waiting = np.unique(labels, return_inverse=True)[1], np.ones(m, dtype=bool)
    near: list[np.ndarray] = []  # distances to the first pivots
    pairs = []
    for i in range(m):
        open_ = waiting & (component != component[i])
        open_ &= (sets.n * 100 >= percent * sets.n[i]) & (sets.n[i] * 100 >= percent * sets.n)
        for d in near:
            if not open_.any():
                break
            open_ &= np.abs(d - d[i]) <= limit
        waiting[i] = False
        if not open_.any():
            continue
        shared = sets.shared_with(sets.of(i))
        for j in np.flatnonzero(_linked(shared, sets.n[i], sets.n, percent) & (component != component[i])):
            if component[j] != component[i]:
                pairs.append((i, j))
                component[component == component[j]] = component[i]
        if len(near) < PIVOTS:
            near.append(1 - shared / (sets.n[i] + sets.n - shared))
    return np.array(pairs, dtype=np.int64).reshape(-1, 2)


def _edges_of_regions(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside each region; members are (region, node, label, set)."""

    def join(part: pa.Table) -> pa.Table:
        node, label = part.column("node").to_numpy(), part.column("label").to_numpy()
        order = np.argsort(node, kind="stable")
        column = part.column("set").combine_chunks()
        pairs = connect([column[int(i)].as_py() for i in order], label[order], percent)
        return pa.table({"a": node[order][pairs[:, 0]].astype(np.int64), "b": node[order][pairs[:, 1]].astype(np.int64)})

    return members.groupBy("region").applyInArrow(join, "a long, b long")


def _distances(dealt: DataFrame, pivots: DataFrame) -> DataFrame:
    """(region, pivot, node, shared, whole): what every set of a region, dealt into blocks, shares
    with each pivot of the region (region, node, set, blocks), and how much both have."""
    sent = pivots.select("region", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node", "set", F.lit(True).alias("pivot"))

    def measure(part: pa.Table) -> pa.Table:
        pivot = part.column("pivot").to_numpy().astype(bool)
        node, packed = part.column("node").to_numpy(), part.column("set").combine_chunks()
        rest = np.flatnonzero(~pivot)
        sets = Sets([packed[int(i)].as_py() for i in rest])
        out = []
        for p in np.flatnonzero(pivot):
            values = np.frombuffer(packed[int(p)].as_py(), np.uint64)
            shared = sets.shared_with(values)
            out.append((np.full(len(rest), node[p]), node[rest], shared, len(values) + sets.n - shared))
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4
        region = part.column("region")[0].as_py()
        return pa.table({"region": np.full(len(cols[0]), region, np.int64), **dict(zip(("pivot", "node", "shared", "whole"), cols, strict=True))})

    both = dealt.select("region", "block", "node", "set", F.lit(False).alias("pivot")).unionByName(sent)
    return both.groupBy("region", "block").applyInArrow(measure, "region long, pivot long, node long, shared long, whole long")


def _joined_labels(part: pa.Table) -> pa.Table:
    """Of a region's pivots (node, label) and links between them (node, other), at most PIVOTS + 1
    squared rows, the least label that each is connected to."""
    node, other, label = (part.column(c).to_numpy() for c in ("node", "other", "label"))
    now = dict(zip(node[node == other].tolist(), label[node == other].tolist(), strict=True))
    for a, b in zip(node.tolist(), other.tolist(), strict=True):
        low, high = sorted((now[a], now[b]))
        now = {n: low if x == high else x for n, x in now.items()}
    region = part.column("region")[0].as_py()
    return pa.table({"region": np.full(len(now), region, np.int64), "pivot": np.array([*now], np.int64), "joined": np.array([*now.values()], np.int64)})


def _voronoi(rows: DataFrame, sizes: DataFrame, percent: int, level: int, keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One level of regions (region, node, label, set) of known sizes: links of sets to their pivots,
    the cells as regions, and the regions that cells don't make smaller."""
    limit = 1 - percent / 100 + _SLACK
    blocks = sizes.select("region", "sets", F.ceil(F.col("sets") / (REGION_SETS // 2)).cast("int").alias("blocks"))
    dealt = keep(rows.join(blocks, "region").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "dealt")
    # pivots: the sets of least hash of this level, some from each block and of these a few in all
    chance = F.pmod(F.xxhash64("node", F.lit(level + 1)), F.col("blocks") * (REGION_SETS // 2)) < 4 * PIVOTS
    few = dealt.groupBy("region").agg(
        F.slice(F.array_sort(F.collect_set(F.when(chance, F.col("node")))), 1, PIVOTS).alias("tried"), F.min("node").alias("least"))
    tried = few.select("region", F.explode(F.array_union("tried", F.array("least"))).alias("node"))
    pivots = keep(tried.join(dealt.select("region", "node", "label", "set", "blocks"), ["region", "node"]), "pivots")
    measured = _distances(dealt, pivots).withColumns({
        "distance": 1 - F.col("shared") / F.col("whole"), "inside": F.col("shared") * 100 >= F.col("whole") * percent})
    measured = keep(measured.drop("shared", "whole"), "measured")
    nearest = F.struct("distance", "pivot")
    home = measured.groupBy("region", "node").agg(
        F.min_by("pivot", nearest).alias("home"), F.min("distance").alias("least"), F.min_by("inside", nearest).alias("in_ball"))
    links = measured.filter("inside").join(pivots.select("region", "node", "label"), ["region", "node"]).select("region", "node", F.col("pivot").alias("other"), "label")
    joined = links.groupBy("region").applyInArrow(_joined_labels, "region long, pivot long, joined long")
    home = keep(home.join(joined, (home["region"] == joined["region"]) & (home["home"] == joined["pivot"])).select(
        home["region"], "node", "home", "least", "in_ball", "joined"), "home")
    edges = home.filter("in_ball AND home <> node").select(F.col("home").alias("a"), F.col("node").alias("b")).unionByName(
        links.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    window = F.least(F.col("least") + 2 * limit, F.lit((RADIUS + 1) * limit))
    cells = measured.join(home, ["region", "node"]).filter(F.col("distance") <= window).select("region", "pivot", "node")
    far = home.filter(F.col("least") > RADIUS * limit).select("region", F.lit(-1).cast("long").alias("pivot"), "node")
    cells = keep(cells.unionByName(far), "cells")
    widest = cells.groupBy("region", "pivot").count().groupBy("region").agg(F.max("count").alias("widest"), F.sum("count").alias("copies"))
    shrinks = (F.col("widest") <= LEAST_SHRINK * F.col("sets")) & (F.col("copies") <= 4 * F.col("sets"))
    fate = keep(blocks.select("region", "sets").join(widest, "region").select("region", shrinks.alias("shrinks")), "fate")
    label = F.when(F.col("in_ball"), F.col("joined")).otherwise(F.col("label")).alias("label")
    known = keep(dealt.select("region", "node", "label", "set").join(home.select("region", "node", "in_ball", "joined"), ["region", "node"]).join(
        fate, "region").select("region", "node", label, "set", "shrinks"), "labelled")
    inner = cells.join(known.filter("shrinks"), ["region", "node"]).select(
        F.xxhash64("region", "pivot", F.lit(level)).alias("region"), "node", "label", "set")
    inner = keep(inner, "inner")
    mixed = inner.groupBy("region").agg((F.min("label") < F.max("label")).alias("mixed")).filter("mixed").select("region")
    return edges, inner.join(mixed, "region"), known.filter("NOT shrinks").drop("shrinks")


def _edges_of_blocks(rows: DataFrame, percent: int, keep) -> DataFrame:
    """Links between the labels of regions (region, node, label, set): the sets outside of the most
    frequent label, in blocks, against all sets, in blocks."""
    counts = keep(rows.groupBy("region", "label").agg(F.count(F.lit(1)).alias("sets")), "labels")
    dealt = counts.groupBy("region").agg(F.max_by("label", F.struct("sets", "label")).alias("main"), F.max("sets").alias("most"), F.sum("sets").alias("sets"))
    per = F.lit(max(1, REGION_SETS // 2))
    dealt = dealt.filter("most < sets").select(
        "region", "main", F.ceil(F.col("sets") / per).cast("int").alias("blocks"), F.ceil((F.col("sets") - F.col("most")) / per).cast("int").alias("bys"))
    rows = rows.join(dealt, "region")
    hashed = F.xxhash64("node")
    every = rows.select("region", F.pmod(hashed, F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("bys") - 1)).alias("by"),
                        "node", "label", "set", F.lit(False).alias("outer"))
    outer = rows.filter("label <> main").select("region", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                                F.pmod(hashed, F.col("bys")).alias("by"), "node", "label", "set", F.lit(True).alias("outer"))

    def compare(part: pa.Table) -> pa.Table:
        is_outer, node, label = part.column("outer").to_numpy().astype(bool), part.column("node").to_numpy(), part.column("label").to_numpy()
        packed = part.column("set").combine_chunks()
        rest = np.flatnonzero(~is_outer)
        sets = Sets([packed[int(i)].as_py() for i in rest])
        pairs = []
        for z in np.flatnonzero(is_outer):
            values = np.frombuffer(packed[int(z)].as_py(), np.uint64)
            found = np.flatnonzero(_linked(sets.shared_with(values), len(values), sets.n, percent) & (label[rest] != label[z]))
            # one link to a label connects it
            found = found[np.unique(label[rest[found]], return_index=True)[1]]
            pairs += [(node[z], node[rest[j]]) for j in found]
        pairs = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return every.unionByName(outer).groupBy("region", "block", "by").applyInArrow(compare, "a long, b long")


def links_of(members: DataFrame, percent: int, keep) -> DataFrame:
    """Links (a, b) that connect what all links inside of regions (region, node, set) connect."""
    rows, links, level = keep(members.withColumn("label", F.col("node")), "members"), None, 0
    while True:
        sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.octet_length("set") / 8).alias("values"))
        large = F.col("sets") > F.greatest(F.lit(2), F.least(F.lit(REGION_SETS), F.lit(REGION_VALUES) * F.col("sets") / F.col("values")))
        sizes = keep(sizes.withColumn("large", large), "sizes")
        marked = rows.join(sizes.select("region", "large"), "region")
        found = _edges_of_regions(marked.filter("NOT large").drop("large"), percent)
        links = found if links is None else links.unionByName(found)
        if not sizes.filter("large").take(1):
            return links
        edges, rows, stuck = _voronoi(marked.filter("large").drop("large"), sizes.filter("large"), percent, level, keep)
        links = links.unionByName(edges).unionByName(_edges_of_blocks(stuck, percent, keep))
        rows, level = keep(rows, "level"), level + 1


def join_components(docs: DataFrame, keep, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    whole = keep(profiles(texts, width, percent).withColumn("owner", F.monotonically_increasing_id()), "profiles")
    n_rows, entries = whole.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("part") / 8), F.lit(0.0))).first()
    hits = shingles.shared_counts(
        whole.select("owner", "part"), _packed_reader(0, 1), shingles.bucket_count(spark, int(entries)),
        n_groups=max(8, -(-n_rows // (1 << 16))))
    alive = keep(whole.join(hits, "owner").filter("hits >= need").drop("part", "need"), "alive")

    key = ["n", "k1", "k2"]
    classes = keep(alive.groupBy(*key).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                   .withColumn("node", F.monotonically_increasing_id()), "classes")
    # copies that share an id may give a set twice; that costs work and changes no link
    # always a merge join of compressed texts, so that the plan is the same at every size
    wanted = classes.select("node", "k1", "k2", "least").hint("merge")
    found = packed(texts).join(wanted, F.col("doc_id").eqNullSafe(F.col("least")))
    sets = keep(_whole_sets(found.select("node", "k1", "k2", "text"), width), "sets")

    n_sets, entries = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    read = _packed_reader(0, 1)
    often = shingles.frequent(sets.select("node", "set"), read, max(1 << 16, entries >> 20), entries)
    shared = shingles.shared_counts(
        sets.select("node", "set"), read, shingles.bucket_count(spark, entries), often, max(8, -(-n_sets // 4096)))
    rarest = keep(_rarest(shared, percent), "rarest")
    pivots = rarest.groupBy("value").agg(F.min("node").alias("region"), F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    regions = keep(rarest.join(pivots, "value").select("region", "node").distinct(), "regions")
    links = links_of(regions.join(sets.select("node", "set"), "node").select("region", "node", "set"), percent, keep)
    reached = components(links, keep)
    named = classes.select(*key, "node", F.col("least").alias("least_id")).join(reached, "node", "left")
    named = named.select(*key, "least_id", F.coalesce("least", "node").alias("group"))
    named = keep(named, "named")
    ids = named.groupBy("group").agg(F.min("least_id").alias("component_id"))
    named = keep(named.join(ids, "group").select(*key, "component_id"), "components")
    out = whole.drop("part", "need").join(named, key, "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
