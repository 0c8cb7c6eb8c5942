"""Substring dedup and Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffcast.llm import metric_join, superkmers, words
from staffcast.llm.stages import Kept

WORD = re.compile(words.WORD)


def corpus(seed, n=120):
    """Short texts with shared passages, near copies, copies, nulls and repeated rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passages = [" ".join(rng.choices(vocabulary, k=k)) for k in (13, 20, 60)]
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.2 and out:
            text = rng.choice(out)
            if text and rng.random() < 0.7:
                parts = text.split(" ")
                for _ in range(rng.randint(1, 4)):
                    parts[rng.randrange(len(parts))] = rng.choice(vocabulary)
                text = " ".join(parts)
        elif kind < 0.5:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(5, 40))) + "\n" + rng.choice(passages) + "  " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 20)))
        elif kind < 0.6:
            text = rng.choice([None, "", "  \t ", "one", "one two three", "a b c d e", "A B c D e"])
        else:
            text = " ".join(rng.choices(vocabulary, k=rng.randint(1, 80))).replace("w1", "W1")
        out.append(text)
    return list(enumerate(out, start=10))


def removed_by_hand(rows, width):
    first = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < doc:
                gone.update(range(i, i + width))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


@pytest.mark.parametrize("seed, bucket_bytes", [(1, 6 << 20), (2, 200), (3, 50)])
def test_repeats_are_those_of_brute_force(spark, seed, bucket_bytes):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1)).repartition(5)
    got = superkmers.remove_repeats(docs, bucket_bytes=bucket_bytes)
    assert got.columns == ["doc_id", "text", "n_words", "n_removed", "kept"]
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect())
    assert found == removed_by_hand(rows, 13)
    assert {(r.doc_id, r.text) for r in got.collect()} == set(rows)


def test_hot_minimisers_change_nothing(spark, monkeypatch):
    rows = [(i, " ".join(f"u{i}x{k}" for k in range(6)) + " the hot line of words that all of these documents share today " + " ".join(f"v{i}x{k}" for k in range(i % 9))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(superkmers, "hot_minimisers", lambda d, w, g, c, t, real=superkmers.hot_minimisers: real(d, w, g, 10, t))
    got = superkmers.remove_repeats(docs, width=8)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == removed_by_hand(rows, 8)


def test_ids_that_are_null_or_repeated(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (5, text), (5, text), (7, text + " more"), (None, None)]
    got = superkmers.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or -1), r.n_removed) for r in got) == [(-1, 0), (-1, 20), (5, 0), (5, 0), (7, 20)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert superkmers.remove_repeats(empty).count() == 0


def components_by_hand(rows, percent=80):
    sets = []
    for doc, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group):
        least[g] = min(least.get(g, doc), doc)
    return sorted((doc, len(s), least[g]) for (doc, _), s, g in zip(rows, sets, group))


def near_copies(seed, n, length, edits):
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append((1000 + i, " ".join(text)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_brute_force(spark, seed):
    rows = corpus(seed) + near_copies(seed, 60, 70, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).repartition(5)
    got = metric_join.join_components(docs, Kept(spark))
    assert sorted(map(tuple, got.collect())) == components_by_hand(rows)


def test_large_regions_of_near_copies(spark, monkeypatch):
    """Regions as narrow as the window, which cells don't make smaller."""
    monkeypatch.setattr(metric_join, "REGION_SETS", 12)
    monkeypatch.setattr(metric_join, "PIVOTS", 3)
    rows = near_copies(5, 70, 60, 6) + near_copies(6, 40, 80, 9) + corpus(4, 40)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = metric_join.join_components(docs, Kept(spark))
    assert sorted(map(tuple, got.collect())) == components_by_hand([(i, t) for i, (_, t) in enumerate(rows)])


def groups_of_links(n, links):
    group = list(range(n))
    for a, b in links:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    return group


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cells_are_split_again_and_lose_no_link(spark, monkeypatch, seed):
    """One region of groups at many distances: its Voronoi cells are regions of a second level, and
    after each level the links found so far and those still to be found connect what all connect."""
    monkeypatch.setattr(metric_join, "REGION_SETS", 12)
    monkeypatch.setattr(metric_join, "PIVOTS", 8)
    rng = random.Random(seed)
    common, sets = list(range(40)), []
    for group in range(12):
        base = rng.sample(common, 12) + [1000 * (group + 1) + i for i in range(40)]
        for _ in range(rng.choice([2, 9, 25])):
            mine = list(base)
            for _ in range(rng.randint(0, 9)):
                mine[rng.randrange(len(mine))] = rng.randrange(10**6, 10**7)
            sets.append(set(mine))
            base = mine if rng.random() < 0.3 else base  # chains leave the first set's ball
    rng.shuffle(sets)
    sets = [s for i, s in enumerate(sets) if s not in sets[:i]]
    packed = [np.array(sorted(s), np.uint64).tobytes() for s in sets]
    members = spark.createDataFrame([(7, i, p) for i, p in enumerate(packed)], "region long, node long, set binary").repartition(3)
    levels, split = [], metric_join._voronoi

    def counted(rows, sizes, percent, level, keep):
        out = split(rows, sizes, percent, level, keep)
        levels.append((level, sizes.count(), out[1].select("region").distinct().count()))
        return out

    monkeypatch.setattr(metric_join, "_voronoi", counted)
    found = [(r.a, r.b) for r in metric_join.links_of(members, 80, Kept(spark)).collect()]
    every = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert {(max(p), min(p)) for p in found} <= set(every)
    assert groups_of_links(len(sets), found) == groups_of_links(len(sets), every)
    assert len(levels) >= 2 and levels[0][2] > 1, levels


def test_join_of_odd_rows(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "A b C d e f"), (9, "x"), (8, "X"), (4, None), (4, ""), (None, None)]
    got = metric_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), Kept(spark)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [
        (-1, 0, -1), (-1, 2, 3), (3, 2, 3), (3, 2, 3), (4, 0, 4), (4, 0, 4), (8, 1, 8), (9, 1, 8)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert metric_join.join_components(empty, Kept(spark)).count() == 0


@pytest.mark.parametrize("percent, size", [(80, 8), (90, 13), (95, 23)])
def test_texts_and_their_one_word_extensions_link(spark, percent, size):
    """n shingles and one more are at n / (n + 1), just enough, whichever hash is the least."""
    rng = random.Random(percent)
    rows = []
    for i in range(300):
        w = [f"v{rng.randrange(10**9)}" for _ in range(size + 1)]
        rows += [(2 * i, " ".join(w[:-1])), (2 * i + 1, " ".join(w))]
    got = metric_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), Kept(spark), percent=percent).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: d - d % 2 for d, _ in rows}


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_hits_that_a_link_makes_certain(percent):
    """Never more than the worst pair of a set and a linked one has, over all their sizes."""
    part = lambda n: min(n, n * (100 - percent) * 3 // 200 + 1)
    for n in range(1, 200):
        worst = min(
            min(part(n) - (n - c), part(m) - (m - c))
            for m in range(-(-percent * n // 100), 100 * n // percent + 1)
            for c in [-(-percent * (n + m) // (100 + percent))])
        need = int(metric_join.least_hits(np.array([n]), percent)[0])
        assert 1 <= need <= max(1, worst) and need >= worst - 2


def test_a_very_long_text_beside_its_copy(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(150_000)]
    other = long[:-100] + [f"z{i}" for i in range(100)]
    rows = [(5, " ".join(long)), (6, " ".join(other)), (7, "a b c d e f")]
    got = metric_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), Kept(spark)).collect()
    assert {r.doc_id: r.component_id for r in got} == {5: 5, 6: 5, 7: 7}
