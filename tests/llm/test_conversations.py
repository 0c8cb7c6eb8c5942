"""Chat formatting and the prefix trie against brute force over plain Python lists."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from staffcast.llm import chat, ordered, prefix_trie
from staffcast.llm.stages import Kept

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "conv_id long, turn long, role string, text string"
SAYS = "</s>[INST] ok [/INST]"
ODD = [
    (-1, 0, "user", SAYS), (-1, 1, "assistant", SAYS), (-2, 0, "user", SAYS), (-2, 1, "assistant", "[\\\\INST] <\\s> [TEXT][TEX T] é𝄞"),
    (-2, 2, "tool[TEXT]", "a[/ROLE]b"), (-2, 3, "", ""), (-2, None, None, None), (-3, 0, "user", SAYS), (-3, 1, "assistant", SAYS),
    (-3, 1, "assistant", "x"), (-3, 9, "assistant", ""), (-4, 0, "user", SAYS), (-4, 1, "user", "z"), (None, 0, "user", "nobody"),
    (-5, 0, "user", "<s>"), (-5, 0, "user", "<s>"), (-6, 0, "assistant", "long " * 40_000), (100, 0, "system", "\\"), (2**40, 5, "user", SAYS),
]


def rows_of(rows):
    """Turns (role, text) of every conversation, in the stated order."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(t[2], t[4]) for t in sorted(v)] for c, v in found.items()}


def random_rows(seed):
    """Conversations that share beginnings, one of them by a third of all, and long chains."""
    rng = random.Random(seed)
    rows = []
    for c in range(260):
        turns = rng.randrange(1, 9) if c != 7 else 400
        for t in range(turns):
            text = "hello" if t == 0 and c % 3 == 0 else f"{rng.choice('abc')} {rng.choice('xyz')}"
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "system", text))
    return rows


def bare_table(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    clashing = ("place", "depth", "owner", "part", "chain", "ids", "n_tokens", "tree")
    return table.select("*", *[F.lit("x").alias(c) for c in clashing]).repartition(5)


# --- running sums --------------------------------------------------------------


def test_running_sums_of_a_group_over_many_tasks(spark):
    rows = [(g, i, (g * 7 + i) % 5 + (1 << 61)) for g, n in ((1, 5000), (2, 1), (3, 40), (2**50, 900)) for i in range(n)]
    table = spark.createDataFrame(rows, "g long, i long, v long").repartition(7)
    got = ordered.running(table, ["g"], [F.desc("i")], {"s": "v", "again": "i"}, Kept(spark)).collect()
    total, other, want = defaultdict(int), defaultdict(int), set()
    for g, i, v in sorted(rows, key=lambda r: (r[0], -r[1])):
        total[g] = (total[g] + v) & ordered.MASK
        other[g] += i
        want.add((g, i, v, total[g], other[g]))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_running_sums_of_nothing(spark):
    table = spark.createDataFrame([], "g long, i long, v long")
    assert ordered.running(table, ["g"], ["i"], {"s": "v"}, Kept(spark)).collect() == []


def test_digests_stream_in_order(spark):
    rows = [(k, i, None if i % 7 == 3 else f"{k}-{i}".encode(), i) for k, n in ((5, 3000), (6, 1), (-1, 4)) for i in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    got = ordered.digests(spark.createDataFrame(rows, "k long, i long, v binary, n long"), ["k"], ["i"], ["v"], b",", ["n"]).collect()
    want = set()
    for key in (5, 6, -1):
        mine = [r for r in rows if r[0] == key]
        want.add((key, hashlib.sha256(b",".join(r[2] for r in mine if r[2] is not None)).hexdigest(), sum(r[3] for r in mine)))
    assert {tuple(r) for r in got} == want


# --- chat ------------------------------------------------------------------------


def check_trees(spark, rows):
    trees, members = chat.format_trees(bare_table(spark, rows), RANKS, PATTERN, Kept(spark))
    turns = chat.read_back(trees, members, RANKS, PATTERN, Kept(spark))
    want = rows_of(rows)
    back = defaultdict(dict)
    for r in turns.collect():
        back[r.conv_id][r.depth] = r
    assert {c: [(t[d].role, t[d].text) for d in sorted(t)] for c, t in back.items()} == want
    bare = re.compile(chat._BARE)
    for c, t in back.items():
        for r in t.values():
            assert r.masked == (r.text if r.role == "assistant" else None)
            begin, end = chat.AROUND.get(r.role, ("[ROLE]" + bare.sub(lambda m: m[0] + "\\", r.role) + "[TEXT]", "[/ROLE]"))
            assert r.formatted == begin + bare.sub(lambda m: m[0] + "\\", r.text) + end
    for r in chat.summary(turns).collect():
        said = want[r.conv_id]
        loss = "".join(t for role, t in said if role == "assistant")
        spelled = "".join(f"{role}\n{t}\n" for role, t in said)
        assert (r.n_turns, r.turns_sha256) == (len(said), hashlib.sha256(spelled.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == sum(len(t.formatted) for t in back[r.conv_id].values())
    # shared turns once, trees without gaps, depth first
    nodes = {(r.chain, r.depth): r for r in trees.collect()}
    prefixes = {tuple(t[: d + 1]) for t in want.values() for d in range(len(t))}
    assert len(nodes) == len(prefixes)
    of_tree = defaultdict(list)
    for r in nodes.values():
        of_tree[r.tree].append(r)
        assert len(r.ids) == 4 * r.n_tokens
    for tree in of_tree.values():
        tree.sort(key=lambda r: r.start)
        assert [r.start for r in tree] == np.cumsum([0, *(r.n_tokens for r in tree)])[:-1].tolist()
    # positions count a conversation's own tokens, and attention sees them and nothing else
    for m in members.collect():
        position, seen, order = 0, set(), []
        for on in m.path:
            for depth in range(on.first, on.last + 1):
                r = nodes[on.chain, depth]
                order.append((r.tree, depth))
                assert r.tree == m.tree and r.position == position
                seen |= set(range(r.start, r.start + r.n_tokens))
                position += r.n_tokens
                sees = [*r.attends, (r.chain_start, r.start + r.n_tokens)]
                assert set().union(*(range(a, b) for a, b in sees)) == seen
                assert sum(b - a for a, b in sees) == len(seen)
        assert m.n_turns == len(order)


def test_odd_conversations_come_back(spark):
    check_trees(spark, ODD)


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_share_and_attend_as_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(chat, "_BLOCK", 16)
    check_trees(spark, random_rows(seed) + ODD)


def test_no_conversations(spark):
    trees, members = chat.format_trees(bare_table(spark, ODD).limit(0), RANKS, PATTERN, Kept(spark))
    assert trees.count() == members.count() == 0
    assert chat.summary(chat.read_back(trees, members, RANKS, PATTERN, Kept(spark))).count() == 0


@pytest.mark.parametrize("text", ["", "[INST]", "<s>", "</s>", "<\\s>", "[\\\\/ROLE]", "<<s>>", "[[TEXT]]", "[TEXT", "\\", "a\\[b"])
def test_escapes_hide_controls_and_are_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(chat.escaped(F.col("t")).alias("e"))
    row = row.select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row.u == text and not any(c in row.e for c in chat.CONTROLS)


# --- prefix trie -----------------------------------------------------------------


def brute_trie(rows):
    own = rows_of(rows)
    new = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        new[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes, children = defaultdict(list), defaultdict(int)
    for c in sorted(new):
        for d in range(len(new[c]) + 1):
            nodes[new[c][:d]].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] += not children[n]
        saved[n] += (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0)
        if n:
            children[n[:-1]] += 1
            leaves[n[:-1]] += leaves[n]
            saved[n[:-1]] += saved[n]
    return {
        (m[0], len(n), nodes[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n],
         hashlib.sha256(",".join(str(c) for c in m if len(new[c]) == len(n)).encode()).hexdigest())
        for n, m in nodes.items()}


@pytest.mark.parametrize("seed, nodes", [(3, 4096), (4, 24), (5, 1)])
def test_subtree_sums_are_those_of_brute_force(spark, monkeypatch, seed, nodes):
    rows = random_rows(seed) + ODD
    if nodes == 1:  # every split in Spark
        rows = [r for r in rows if r[0] is not None and (r[0] < 20 and r[0] != 7)]
    monkeypatch.setattr(prefix_trie, "COMPONENT_NODES", nodes)
    monkeypatch.setattr(prefix_trie, "TASK_NODES", 64)
    got = prefix_trie.branched_trie(bare_table(spark, rows), Kept(spark)).collect()
    want = brute_trie(rows)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_trie_of_nothing_and_of_turnless(spark):
    assert prefix_trie.branched_trie(bare_table(spark, ODD).limit(0), Kept(spark)).count() == 0
    # conversation 3 has h = 1 (its base is absent), so nothing of its one turn stays
    lone = [(c, 0, "user", "x") for c in (3, 5, 9) if zlib.crc32(str(c).encode()) % 6]
    got = prefix_trie.branched_trie(bare_table(spark, lone), Kept(spark)).collect()
    assert {tuple(r) for r in got} == brute_trie(lone)
    assert any(r.depth == 0 and r.parent_conv_id is None for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_centroid_sums_of_any_forest(seed):
    rng = np.random.default_rng(seed)
    n = 300
    parent = np.array([-1 if i < 3 else rng.integers(max(0, i - (2 if seed % 2 else i)), i) for i in range(n)])
    depth = np.zeros(n, dtype=np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    weights = rng.integers(0, 9, (n, 2))
    want = weights.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (prefix_trie.split_small(parent, depth, weights) == want).all()
