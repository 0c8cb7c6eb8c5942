"""Sums over all subtrees of the prefix tree of conversations, by centroid decomposition.

The parent edges make a tree as deep as the longest conversation and as wide as there are
first turns, so neither a level at a time nor a path at a time is balanced. Instead every
component of the forest is split at its centroid, the deepest node whose part of the component
is more than half. The part below the centroid is summed; that total is the centroid's own
answer and is added along the path from the centroid to the component's top, and the centroid
goes. The parts below its children and the part above are components of the next round, none
with more than half of the nodes, so rounds grow with the logarithm of the largest component
and a node is on a path at most once a round.

Components with more than COMPONENT_NODES nodes are split in Spark, all of them in one round.
Where a node lies is read from the conversation that it is named by: the owner at the
centroid's depth tells whether the centroid is above it, the owner one deeper which child is.
Smaller components travel whole, many to a task, and are split there by the same rule.

Defined results: repeated rows are turns of their own; rows without a conv_id are left out;
other columns are ignored; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staffcast.llm.conversations import ordered_turns, owners
from staffcast.llm.ordered import digests

COMPONENT_NODES = 4096  # larger components are split in Spark
TASK_NODES = 1 << 16  # nodes of small components expected in one task
_NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of no bytes


def branched(turns: DataFrame, keep) -> DataFrame:
    """(conv, depth, a, b, chars): conversations rebuilt as branches of others. Conversation c
    begins with the first h turns of c - c % 100 and goes on with its own after its first h,
    where h is the CRC-32 of its decimal digits modulo 6. Also gives, as `convs`, all ids."""
    rows = turns.select("conv_id", "place", "a", "b", F.char_length("text").cast("long").alias("chars"))
    rows = keep(rows, "turns")
    lengths = rows.groupBy("conv_id").agg(F.max("place").alias("turns"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(6))
    convs = lengths.select(F.col("conv_id").alias("conv"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h.alias("h"))
    convs = convs.join(lengths.select(F.col("conv_id").alias("base"), F.col("turns").alias("base_turns")), "base", "left")
    convs = keep(convs.select("conv", "base", "h", F.least("h", F.coalesce("base_turns", F.lit(0))).alias("shared")), "convs")
    first = rows.filter("place <= 5").select(F.col("conv_id").alias("base"), "place", "a", "b", "chars")
    begin = convs.join(first, "base").filter("place <= h").select("conv", F.col("place").alias("depth"), "a", "b", "chars")
    rest = rows.join(convs, F.col("conv_id") == F.col("conv")).filter("place > h").select(
        "conv", (F.col("shared") + F.col("place") - F.col("h")).alias("depth"), "a", "b", "chars")
    return begin.unionByName(rest), convs.select("conv")


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def split_small(parent: np.ndarray, depth: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums of weights (rows) over the subtrees of a forest, parent -1 at its tops, by centroid
    decomposition of all its components at once."""
    n = len(parent)
    size = np.ones(n, dtype=np.int64)
    for level in reversed(_levels(depth)):
        level = level[parent[level] >= 0]
        np.add.at(size, parent[level], size[level])
    # places in depth-first order: a node's subtree is a span of them
    place, top = np.zeros(n, dtype=np.int64), np.arange(n)
    tops = np.flatnonzero(parent < 0)
    place[tops] = np.cumsum(size[tops]) - size[tops]
    for level in _levels(depth):
        level = level[parent[level] >= 0]
        level = level[np.argsort(parent[level], kind="stable")]
        begin = np.flatnonzero(np.append(True, np.diff(parent[level]) != 0)) if len(level) else level
        before = np.cumsum(size[level]) - size[level]
        before -= np.repeat(before[begin], np.diff(np.append(begin, len(level))))
        place[level] = place[parent[level]] + 1 + before
        top[level] = top[parent[level]]
    whole, out = size.copy(), np.zeros_like(weights)
    live = np.arange(n)
    while len(live):
        heavy = live[2 * size[live] > size[top[live]]]
        heavy = heavy[np.lexsort((depth[heavy], top[heavy]))]
        centroid = heavy[np.append(top[heavy][1:] != top[heavy][:-1], True)]
        of = np.full(n, -1)
        of[top[centroid]] = centroid
        mine = of[top[live]]
        below = (place[live] >= place[mine]) & (place[live] < place[mine] + whole[mine])
        total = np.zeros_like(weights)
        np.add.at(total, mine[below], weights[live[below]])
        out[centroid] += total[centroid]
        # along the paths from the centroids to the tops, one step of all paths at a time
        gone, at, source = size[centroid].copy(), centroid, centroid
        while True:
            on = at != top[source]
            at, source, gone = parent[at[on]], source[on], gone[on]
            if not len(at):
                break
            out[at] += total[source]
            size[at] -= gone
        under = live[below & (live != mine)]
        if len(under):
            children = under[np.isin(parent[under], centroid)]
            span = int(place.max()) + 1
            keys = top[children] * span + place[children]
            order = np.argsort(keys)
            found = np.searchsorted(keys[order], top[under] * span + place[under], side="right") - 1
            top[under] = children[order][found]
        live = live[live != mine]
    return out


def _split_group(part: pa.Table) -> pa.Table:
    columns = {c: part.column(c).to_numpy() for c in ("owner", "depth", "parent", "comp_owner", "comp_depth")}
    owner, depth = columns["owner"], columns["depth"]
    order = np.lexsort((owner, depth))
    span = np.int64(len(order) + 1)
    names = np.unique(np.concatenate([owner, columns["parent"]]))
    keys = depth[order] * len(names) + np.searchsorted(names, owner[order])
    want = (depth - 1) * len(names) + np.searchsorted(names, columns["parent"])
    at = np.minimum(np.searchsorted(keys, want), span - 2)
    inner = (owner != columns["comp_owner"]) | (depth != columns["comp_depth"])
    parent = np.where(inner, order[at], -1)
    weights = np.stack([part.column(c).to_numpy() for c in ("leaves", "saved")], axis=1)
    sums = split_small(parent, depth, weights)
    return pa.table({"owner": owner, "depth": depth, "n_leaves": sums[:, 0] + part.column("leaves_sum").to_numpy(),
                     "saved_tokens": sums[:, 1] + part.column("saved_sum").to_numpy()})


def _split_large(live: DataFrame, paths: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """One round: what is left, and the centroids with their sums."""
    comp = ["comp_owner", "comp_depth"]
    # nodes with more than half of their component below them are a path; its end is the centroid
    centroids = live.filter("2 * size > total").groupBy(*comp).agg(
        F.max_by("owner", "depth").alias("c_owner"), F.max("depth").alias("c_depth"))
    centroids = keep(centroids, "centroids")
    seen = live.join(centroids, comp)
    via = paths.select(F.col("conv").alias("owner"), (F.col("depth") - 1).alias("c_depth"), F.col("owner").alias("child"), F.col("parent").alias("above"))
    seen = seen.join(via, ["owner", "c_depth"], "left")
    is_centroid = (F.col("owner") == F.col("c_owner")) & (F.col("depth") == F.col("c_depth"))
    under = (F.col("depth") > F.col("c_depth")) & (F.col("above") == F.col("c_owner"))
    seen = seen.withColumns({"is_centroid": is_centroid, "under": F.coalesce(under, F.lit(False))})
    seen = keep(seen.drop("above"), "seen")
    totals = keep(seen.filter("under OR is_centroid").groupBy(*comp, "c_owner", "c_depth").agg(
        F.count("*").alias("gone"), F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved")), "totals")
    path = totals.join(paths.select(F.col("conv").alias("c_owner"), "depth", "parent"), "c_owner").filter(
        "depth <= c_depth AND depth > comp_depth").select(
        F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth"), "gone", "add_leaves", "add_saved")
    done = seen.filter("is_centroid").join(totals, [*comp, "c_owner", "c_depth"]).select(
        "owner", "depth", (F.col("leaves_sum") + F.col("add_leaves")).alias("n_leaves"), (F.col("saved_sum") + F.col("add_saved")).alias("saved_tokens"))
    rest = seen.filter("NOT is_centroid").join(path, ["owner", "depth"], "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("gone", "add_leaves", "add_saved")}
    rest = rest.select(
        "owner", "depth", "parent", "leaves", "saved", (F.col("size") - zero["gone"]).alias("size"),
        (F.col("leaves_sum") + zero["add_leaves"]).alias("leaves_sum"), (F.col("saved_sum") + zero["add_saved"]).alias("saved_sum"),
        F.when(F.col("under"), F.col("child")).otherwise(F.col("comp_owner")).alias("comp_owner"),
        F.when(F.col("under"), F.col("c_depth") + 1).otherwise(F.col("comp_depth")).alias("comp_depth"))
    rest = keep(rest, "rest")
    tops = rest.filter("owner = comp_owner AND depth = comp_depth").select(*comp, F.col("size").alias("total"))
    return rest.join(tops, comp), keep(done, "done")


def subtree_sums(nodes: DataFrame, paths: DataFrame, keep) -> DataFrame:
    """(owner, depth, n_leaves, saved_tokens): sums over the subtrees of nodes (owner, depth,
    parent, size, leaves, saved), size being the number of nodes of the subtree. `paths` has
    the nodes of every owner's conversation (conv, depth, owner, parent), but for the root."""
    root = F.lit(0).cast("long")
    top = nodes.filter("depth = 0").select(F.col("owner").alias("comp_owner"), F.col("size").alias("total"))
    live = nodes.crossJoin(F.broadcast(top)).select(  # the root is one row
        "owner", "depth", "parent", "size", "leaves", "saved", root.alias("leaves_sum"), root.alias("saved_sum"),
        "comp_owner", root.alias("comp_depth"), "total")
    small, done = [], []
    live = keep(live, "live")
    while live.filter(F.col("total") > COMPONENT_NODES).take(1):
        small.append(live.filter(F.col("total") <= COMPONENT_NODES))
        live, centroids = _split_large(live.filter(F.col("total") > COMPONENT_NODES), paths, keep)
        live = keep(live, "live")
        done.append(centroids)
    small.append(live)
    for more in small[:-1]:
        live = live.unionByName(more)
    groups = max(1, -(-live.count() // TASK_NODES))
    packed = live.withColumn("task", F.pmod(F.xxhash64("comp_owner", "comp_depth"), F.lit(groups)))
    found = packed.groupBy("task").applyInArrow(_split_group, "owner long, depth long, n_leaves long, saved_tokens long")
    for more in done:
        found = found.unionByName(more)
    return found


def trie(rows: DataFrame, convs: DataFrame, keep) -> DataFrame:
    """The nodes of the prefix tree of conversations (conv, depth, a, b, chars), among them the
    root, with the conversations `convs` (conv) as members: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    reached = keep(owners(rows, keep), "reached")
    root = convs.agg(F.min("conv").alias("owner")).filter("owner IS NOT NULL")
    above = reached.select("conv", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent"))
    paths = reached.join(above, ["conv", "depth"], "left").crossJoin(F.broadcast(root.withColumnRenamed("owner", "root")))
    paths = keep(paths.withColumn("parent", F.coalesce("parent", "root")).drop("root"), "paths")
    # a conversation's own nodes are its last ones; a node's subtree has those of its members at its depth or deeper
    own = paths.groupBy("conv").agg(F.max("depth").alias("length"), F.min(F.when(F.col("owner") == F.col("conv"), F.col("depth"))).alias("first"))
    ends = keep(convs.join(own, "conv", "left").crossJoin(F.broadcast(root)).select(
        "conv", F.coalesce("length", F.lit(0)).alias("length"), "first", F.col("owner").alias("root")), "ends")
    deeper = F.coalesce(F.col("length") - F.greatest("first", "depth") + 1, F.lit(0))
    inner = paths.join(ends.select("conv", "length", "first"), "conv").groupBy("owner", "depth").agg(
        F.min("parent").alias("parent"), F.max("chars").alias("chars"), F.count("*").alias("n_convs"),
        F.sum(F.when(F.col("first").isNotNull(), deeper).otherwise(0)).alias("size"))
    first = F.lit(0).cast("long")
    base = ends.groupBy(F.col("root").alias("owner")).agg(
        F.count("*").alias("n_convs"), (F.sum(F.coalesce(F.col("length") - F.col("first") + 1, F.lit(0))) + 1).alias("size"))
    nodes = keep(inner.unionByName(base.withColumns({"depth": first, "parent": F.lit(None).cast("long"), "chars": first})), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["owner", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = keep(nodes.withColumns({
        "leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}), "weighed")
    sums = subtree_sums(nodes, paths.select("conv", "depth", "owner", "parent"), keep)
    last = ends.join(paths.select("conv", F.col("depth").alias("length"), "owner"), ["conv", "length"], "left").select(
        F.coalesce("owner", "root").alias("owner"), F.col("length").alias("depth"), "conv", F.col("conv").cast("string").cast("binary").alias("ends"))
    spelled = digests(last, ["owner", "depth"], ["conv"], ["ends"], b",")
    out = nodes.join(sums, ["owner", "depth"]).join(spelled, ["owner", "depth"], "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def branched_trie(table: DataFrame, keep) -> DataFrame:
    """The prefix tree of the conversations (conv_id, turn, role, text) rebuilt as branches."""
    rows, convs = branched(ordered_turns(table, keep), keep)
    return trie(rows, convs, keep)
