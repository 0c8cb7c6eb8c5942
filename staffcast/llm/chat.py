"""Chat formatting of conversations as prefix trees, packed depth first.

Conversations that begin with the same turns share them: a node of the tree is a sequence of
initial turns, and its last turn is formatted and encoded once. The nodes of a tree (of one
first turn) are laid out depth first. Where a node starts follows from sums alone, no task
walks a tree: a conversation's own nodes, those it is the smallest member of, are a chain and
lie side by side; after a chain come the chains that branch off it, those of its deepest node
first, then by conversation; each takes the tokens of its whole subtree.

A row of the output is a node: its tree, start in the tree, tokens (packed little-endian
unsigned 32-bit ids), the position id of its first token (the number of tokens before it in
its conversations; the next ones count on), the tokens under the loss mask, and the intervals
of the tree that its tokens attend to besides the node's own chain from `chain_start` on:
those of its ancestors. Within these attention is causal.

The template puts control strings around every turn, one special id each:

    user [INST]text[/INST]    assistant <s>text</s>    system [SYS]text[/SYS]
    other roles [ROLE]role[TEXT]text[/ROLE]

A control string inside a text or role gets a backslash after its first character; one that
already has backslashes there gets one more, so taking one away restores the text.

Defined results: null texts and roles are empty; rows without a conv_id are left out; rows of
one turn stand by role and MD5 of the text; repeated rows are turns of their own; other columns
are ignored; an empty table gives empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staffcast.llm import bpe
from staffcast.llm.conversations import ordered_turns, owners
from staffcast.llm.ordered import digests, running
from staffcast.llm.words import chunks

# The template's control strings, and those around the text of a turn by role.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]")
AROUND = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER, INSIDE, OTHER_END = "[ROLE]", "[TEXT]", "[/ROLE]"
_BARE = r"<(?=\\*/?s>)|\[(?=\\*(?:/?INST|/?SYS|/?ROLE|TEXT)\])"
_GUARDED = r"<(?=\\+/?s>)|\[(?=\\+(?:/?INST|/?SYS|/?ROLE|TEXT)\])"
_BLOCK = 256  # turns of a path looked up at a time


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, f"({_BARE})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_GUARDED})\\", "$1")


def _by_role(user: Column, assistant: Column, system: Column, other: Column) -> Column:
    role = F.col("role")
    return F.when(role == "user", user).when(role == "assistant", assistant).when(role == "system", system).otherwise(other)


def _coded(nodes: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(owner, depth, ids, n_tokens, loss_from, loss_to) of nodes (owner, depth, role, text)."""
    first = max(rank for _, rank in bpe.read_ranks(ranks_path)) + 1
    special = {c: F.lit((first + i).to_bytes(4, "little")) for i, c in enumerate(CONTROLS)}
    known = F.col("role").isin(*AROUND)
    rows = nodes.select("owner", "depth", "role", F.when(~known, escaped(F.col("role"))).alias("name"), escaped(F.col("text")).alias("text"))
    rows = bpe.encode(rows, ranks_path, pattern, "name").withColumnRenamed("ids", "name_ids")
    rows = bpe.encode(rows, ranks_path, pattern)
    begin = _by_role(*(special[a] for a, _ in AROUND.values()), F.concat(special[OTHER], F.col("name_ids"), special[INSIDE]))
    end = _by_role(*(special[b] for _, b in AROUND.values()), special[OTHER_END])
    rows = rows.select("owner", "depth", "role", F.concat(begin, F.col("ids"), end).alias("ids"), "n_tokens")
    taught = F.col("role") == "assistant"
    return rows.select(
        "owner", "depth", "ids", (F.length("ids") / 4).cast("long").alias("n"), F.when(taught, F.lit(1).cast("long")).alias("loss_from"),
        F.when(taught, F.col("n_tokens") + 1).alias("loss_to"))


def format_trees(table: DataFrame, ranks_path: str, pattern: str, keep) -> tuple[DataFrame, DataFrame]:
    """The packed trees of conversations (conv_id, turn, role, text), written: tree, start,
    chain, depth, n_tokens, position, chain_start, attends, loss_from, loss_to, ids. And which
    nodes spell a conversation: conv_id, n_turns, tree, path (of chain, first and last depth)."""
    turns = ordered_turns(table, keep)
    paths = keep(owners(turns.select(F.col("conv_id").alias("conv"), F.col("place").alias("depth"), "a", "b"), keep), "paths")
    own = paths.filter("conv = owner").select("owner", "depth")
    texts = turns.select(F.col("conv_id").alias("owner"), F.col("place").alias("depth"), "role", "text").join(own, ["owner", "depth"])
    coded = keep(_coded(texts, ranks_path, pattern), "coded")

    nodes = running(coded.select("owner", "depth", "n"), ["owner"], ["depth"], {"through": "n"}, keep)
    chains = keep(nodes.groupBy("owner").agg(F.max("through").alias("total"), F.min("depth").alias("first")), "chains")
    segments = keep(paths.groupBy("conv", F.col("owner").alias("chain")).agg(
        F.min("depth").alias("first"), F.max("depth").alias("last")), "segments")

    # tokens of the whole subtree of a chain's first node: the chains of its members
    tops = paths.join(chains.select("owner", F.col("first").alias("depth")), ["owner", "depth"]).select("owner", "conv")
    weights = tops.join(chains.select(F.col("owner").alias("conv"), "total"), "conv").groupBy("owner").agg(F.sum("total").alias("weight"))
    above = paths.select(F.col("conv").alias("owner"), (F.col("depth") + 1).alias("first"), F.col("owner").alias("parent"))
    kids = keep(chains.join(weights, "owner").join(above, ["owner", "first"]).select("parent", "first", "owner", "weight"), "branches")
    kids = running(kids, ["parent"], [F.desc("first"), "owner"], {"upto": "weight"}, keep)
    jumps = kids.join(chains.select(F.col("owner").alias("parent"), "total"), "parent").select(
        F.col("owner").alias("chain"), (F.col("total") + F.col("upto") - F.col("weight")).alias("jump"))

    # a chain starts behind all that comes before it in the chains that lead to it
    led = segments.join(chains.select(F.col("owner").alias("conv")), "conv").join(jumps, "chain", "left")
    starts = keep(led.groupBy(F.col("conv").alias("chain")).agg(
        F.sum(F.coalesce("jump", F.lit(0))).alias("chain_start"), F.min("chain").alias("tree")), "starts")
    over = segments.filter("conv <> chain").join(chains.select(F.col("owner").alias("conv")), "conv").join(starts.drop("tree"), "chain").join(
        nodes.select(F.col("owner").alias("chain"), F.col("depth").alias("last"), "through"), ["chain", "last"])
    interval = F.struct(F.col("chain_start").alias("start"), (F.col("chain_start") + F.col("through")).alias("end"))
    inherited = over.groupBy(F.col("conv").alias("chain")).agg(F.array_sort(F.collect_list(interval)).alias("attends"), F.sum("through").alias("inherited"))
    chained = keep(starts.join(inherited, "chain", "left"), "chained")
    before = F.col("through") - F.col("n")
    placed = nodes.join(chained.withColumnRenamed("chain", "owner"), "owner").select(
        "tree", (F.col("chain_start") + before).alias("start"), "owner", "depth",
        (F.coalesce("inherited", F.lit(0)) + before).alias("position"), "chain_start",
        F.coalesce("attends", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("attends"))
    trees = placed.join(coded, ["owner", "depth"]).select(
        "tree", "start", F.col("owner").alias("chain"), "depth", F.col("n").alias("n_tokens"), "position", "chain_start", "attends", "loss_from", "loss_to", "ids")
    trees = keep(trees.repartitionByRange("tree", "start").sortWithinPartitions("tree", "start"), "trees")
    path = F.array_sort(F.collect_list(F.struct("chain", "first", "last"))).alias("path")
    members = keep(segments.groupBy(F.col("conv").alias("conv_id")).agg(
        F.max("last").alias("n_turns"), F.min("chain").alias("tree"), path), "members")
    return trees, members


def _spelled(trees: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(chain, depth, formatted, masked): the text of a node's tokens, and of those under the mask."""
    ranks = bpe.read_ranks(ranks_path)
    first = max(rank for _, rank in ranks) + 1
    shared = trees.sparkSession.sparkContext.broadcast([*ranks, *((c.encode(), first + i) for i, c in enumerate(CONTROLS))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe._codec(shared, pattern)
        for batch in batches:
            for at, part in chunks(batch.column(4)):
                rows = batch.slice(at, len(part))
                bounds = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
                ids = np.frombuffer(part.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].view("<u4")
                data, lengths = codec.decode(ids)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                token = (bounds - bounds[0]) // 4
                raw = data.tobytes()
                masks = [rows.column(j).to_pylist() for j in (2, 3)]
                out = [raw[ends[token[i]] : ends[token[i + 1]]].decode() for i in range(len(rows))]
                masked = [None if a is None else raw[ends[token[i] + a] : ends[token[i] + b]].decode() for i, (a, b) in enumerate(zip(*masks, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(out, pa.string()), pa.array(masked, pa.string())], names=["chain", "depth", "formatted", "masked"])

    return trees.select("chain", "depth", "loss_from", "loss_to", "ids").mapInArrow(run, "chain long, depth long, formatted string, masked string")


def read_back(trees: DataFrame, members: DataFrame, ranks_path: str, pattern: str, keep) -> DataFrame:
    """(conv_id, depth, role, text, formatted, masked): all turns, from tokens and paths alone."""
    spelled = _spelled(trees, ranks_path, pattern)
    whole = F.col("formatted")

    def inside(begin: str, end: str) -> Column:
        return F.substring(whole, F.lit(len(begin) + 1), F.char_length(whole) - F.lit(len(begin) + len(end)))

    opened = {role: whole.startswith(a) for role, (a, _) in AROUND.items()}
    role, text = F.split_part(inside(OTHER, OTHER_END), F.lit(INSIDE), F.lit(1)), F.split_part(inside(OTHER, OTHER_END), F.lit(INSIDE), F.lit(2))
    role, text = unescaped(role), unescaped(text)
    for name, (a, b) in AROUND.items():
        role = F.when(opened[name], F.lit(name)).otherwise(role)
        text = F.when(opened[name], unescaped(inside(a, b))).otherwise(text)
    nodes = keep(spelled.select("chain", "depth", role.alias("role"), text.alias("text"), "formatted", unescaped(F.col("masked")).alias("masked")), "nodes")
    # a path's depths are listed in blocks, so that no row holds a list as long as a conversation
    steps = members.select("conv_id", F.explode("path").alias("on")).select("conv_id", "on.*")
    block = F.explode(F.sequence(F.floor(F.col("first") / _BLOCK), F.floor(F.col("last") / _BLOCK))).alias("block")
    steps = steps.select("conv_id", "chain", "first", "last", block)
    depth = F.explode(F.sequence(F.greatest("first", F.col("block") * _BLOCK), F.least("last", F.col("block") * _BLOCK + _BLOCK - 1))).alias("depth")
    return steps.select("conv_id", "chain", depth).join(nodes, ["chain", "depth"]).drop("chain")


def summary(turns: DataFrame) -> DataFrame:
    """Per conversation of `read_back`: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    rows = turns.select(
        "conv_id", "depth", F.concat("role", F.lit("\n"), "text", F.lit("\n")).cast("binary").alias("turns"), F.col("masked").cast("binary").alias("loss"),
        F.lit(1).cast("long").alias("n_turns"), F.coalesce(F.char_length("masked"), F.lit(0)).cast("long").alias("loss_chars"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
    return digests(rows, ["conv_id"], ["depth"], ["turns", "loss"], totals=["n_turns", "loss_chars", "formatted_chars"])
