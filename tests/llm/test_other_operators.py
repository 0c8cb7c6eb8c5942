"""Archives, token files, mixing, vectors, models: brute force, round trips, held-out accuracy."""

import base64
import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from staffcast.llm import bpe, caps, components, cross_entropy, mixing, nn_descent, ordinal, stages, token_files, warc
from staffcast.llm.stages import Kept

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


# --- archives ----------------------------------------------------------------

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n"


def pages(spark):
    html = ["<p>x</p>", None, "", FAKE, "é" * 50, "<p>x</p>", "a\r\n\r\nb", "WARC/1.0\r\n", FAKE + FAKE, "<p>x</p>"]
    rows = [(i, f"http://h/{i}\r\nx", h) for i, h in enumerate(html)] + [(None, None, "<p>x</p>"), (20, "u", "z"), (20, "u", "z")]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


@pytest.mark.parametrize("block, least", [("128m", 0), ("150b", 0), ("128m", 5)])
def test_archives_come_back_whole(spark, block, least):
    table, rows = pages(spark)
    keep = Kept(spark)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        warc.write_archives(table.withColumn("payload", F.lit(1)).repartition(2), f"{keep.folder}/a", keep, least)
        got = warc.read_archives(spark, f"{keep.folder}/a", keep).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", -1), page)
    want = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        to = largest.get(html or "") if len(body) >= least else None
        revisit = to is not None and to != page
        want[page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", to if revisit else None, None if revisit else body] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want


def test_no_pages_no_records(spark):
    keep = Kept(spark)
    warc.write_archives(pages(spark)[0].limit(0), f"{keep.folder}/a", keep)
    assert warc.read_archives(spark, f"{keep.folder}/a", keep).count() == 0


def test_pointer_jumping_follows_the_chain_only(spark):
    chain = [("f", i * 10, i * 10 + 10) for i in range(37)] + [("f", 15, 30), ("f", 5, 999), ("g", 10, 20)]
    found = warc.reachable(spark.createDataFrame(chain, "file string, start long, next long"), Kept(spark))
    assert sorted(map(tuple, found.collect())) == [("f", i * 10) for i in range(37)]


# --- token files -------------------------------------------------------------


@pytest.mark.parametrize("part_bytes, block", [(4 << 20, "128m"), (40, "128m"), (30, "64b")])
def test_tokens_are_counted_from_bytes(spark, monkeypatch, part_bytes, block):
    monkeypatch.setattr(token_files, "PART_BYTES", part_bytes)
    texts = [None, "", "a", "hello world " * 7, "PPPP P P\x00", "é日本 " * 9, "x"] * 5
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, ids long").coalesce(1)
    keep = Kept(spark)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        token_files.write_token_files(docs, f"{keep.folder}/t", RANKS, PATTERN)
        got = token_files.count_tokens(spark, f"{keep.folder}/t", keep).orderBy("document").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    codec = bpe.Codec(bpe.read_ranks(RANKS), PATTERN)
    sizes = [len(codec.encode([t])[0]) for t in texts]
    assert [r.n_tokens for r in got] == sizes and all(r.ended for r in got)
    assert [r.start for r in got] == [sum(sizes[:i]) + i for i in range(len(sizes))]


def test_tokens_behind_the_last_separator(spark):
    keep = Kept(spark)
    raw = np.array([7, 0x50C4, 50256, 50256, 9, 9], ">u2").tobytes() + b"\x01"
    spark.createDataFrame([(raw,)], "value binary").select(F.col("value").cast("string")).coalesce(1).write.option("lineSep", "\x02").text(f"{keep.folder}/t")
    got = token_files.count_tokens(spark, f"{keep.folder}/t", keep).orderBy("document").collect()
    assert [(r.start, r.n_tokens, r.ended) for r in got] == [(0, 2, True), (3, 0, True), (4, 3, False)]
    token_files.write_token_files(spark.createDataFrame([], "text string"), f"{keep.folder}/none", RANKS, PATTERN)
    assert token_files.count_tokens(spark, f"{keep.folder}/none", keep).count() == 0


def test_documents_of_token_files(spark):
    """Counts tied to their documents over several files, with long, empty and repeated rows."""
    rows = [(i, "word " * (i % 7) if i % 5 else None) for i in range(90)] + [(7, "x " * 200_000), (7, "again"), (None, "no id")]
    keep = Kept(spark)
    docs = keep(spark.createDataFrame(rows, "doc_id long, text string").withColumn("document", F.lit(1)).repartition(5))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        token_files.write_token_files(docs, f"{keep.folder}/t", RANKS, PATTERN)
        order = token_files.document_order(docs).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    counts = token_files.count_tokens(spark, f"{keep.folder}/t", keep).collect()
    named = {(r.file_number, r.document): r.doc_id for r in order}
    got = Counter((named.pop((int(r.file.split("part-")[1][:5]), r.document)), r.n_tokens) for r in counts)
    codec = bpe.Codec(bpe.read_ranks(RANKS), PATTERN)
    assert got == Counter((i, len(codec.encode([t])[0])) for i, t in rows) and not named
    assert len({r.file_number for r in order}) > 1


# --- mixing ------------------------------------------------------------------


def filled_by_rounds(sizes, weights, share, most):
    """Share by weight, clamp what is above, share the excess again."""
    cap = {s: most * n for s, n in sizes.items()}
    target, left, open_ = {}, share * sum(sizes.values()), set(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > cap[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in open_}
        for s in over:
            target[s] = cap[s]
            left -= cap[s]
        open_ -= over
    return target


def test_targets_and_words_of_a_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 7)
    rng = random.Random(3)
    docs = [(i, " ".join("w" * rng.randint(1, 30)), rng.choice(["a", "b", "B", "é", None, "z"]) if i % 3 else "a") for i in range(600)]
    docs += [(1000, None, "only null"), (1001, "x", None)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(Kept(spark), table.repartition(5)).collect()
    again = mixing.mix(Kept(spark), table.repartition(2)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(docs)
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len((text or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    target = filled_by_rounds(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= 60 for s in sizes)


def test_mix_of_nothing_and_of_repeated_rows(spark):
    assert mixing.mix(Kept(spark), spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    got = mixing.mix(Kept(spark), spark.createDataFrame([(1, "a b", "s")] * 4 + [(None, "c", "t")], "doc_id long, text string, source string")).collect()
    assert len(got) == 5 and sum(r.taken for r in got if r.source == "s") in (10, 12, 14, 16)


# --- vectors -----------------------------------------------------------------


def some_vectors(seed, n=260, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[n // 2:] = x[rng.integers(0, n // 4, n - n // 2)] + 0.04 * rng.standard_normal((n - n // 2, dim)) * np.linalg.norm(x[0]) / math.sqrt(dim) * 3
    x[5] = x[4]
    rows = [(int(i), [float(v) for v in x[i]], int(i) % 2) for i in range(n)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [0.0] * dim, 0), (1003, [float("nan")] * dim, 0), (1004, [None] * dim, 1), (1005, [1.0] * dim, None), (1006, [1.0, 2.0], 0), (None, [1.0] * dim, 1)]
    return rows


def test_links_of_caps_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK_ROWS", 20)
    rows = some_vectors(1)
    got = caps.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n", F.lit(1)), Kept(spark)).collect()
    good = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and i < 1000]
    group, links = {i: i for i, *_ in good}, Counter()
    for i, v, a in good:
        for j, w, b in good:
            if j < i and a == b and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i] += 1
                links[j] += 1
                p, q = sorted((group[i], group[j]))
                group = {k: p if g == q else g for k, g in group.items()}
    assert sum(links.values()) > 200
    for r in got:
        if r.vec_id is not None:
            assert (r.n_links, r.component_id) == (links[r.vec_id], group.get(r.vec_id, r.vec_id)) and r.kept == (r.vec_id == r.component_id)
    assert len(got) == len(rows)
    assert caps.link(spark.createDataFrame([], "vec_id long, embedding array<double>, label int"), Kept(spark)).count() == 0


def test_links_of_vectors_of_any_magnitude(spark):
    """Components that overflow or vanish when squared, against exact fractions."""
    rng = random.Random(3)
    rows = [(i, [v, v], 0) for i, v in enumerate([1e200, 1e200, 1e-200, 1e-200, 1.0, 5e-324, 1.7e308])]
    for i in range(10, 60):
        angle, scale = rng.uniform(0, 1.2), 10.0 ** rng.randint(-300, 300)
        rows.append((i, [scale * math.cos(angle), scale * math.sin(angle)], 1))
    got = {r.vec_id: r for r in caps.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), Kept(spark)).collect()}
    for i, v, label in rows:
        links = 0
        for j, w, other in rows:
            if i != j and label == other:
                a, b = [[Fraction(x) for x in y] for y in (v, w)]
                dot, square = sum(x * y for x, y in zip(a, b)), sum(x * x for x in a) * sum(y * y for y in b)
                links += dot > 0 and dot * dot * 10000 >= 9604 * square
        assert got[i].n_links == links
    assert {got[i].component_id for i in range(7)} == {0} and [i for i in range(7) if got[i].kept] == [0]


def test_many_copies_cost_one_vector(spark):
    table = spark.range(20_000).select((F.col("id") + 5).alias("vec_id"), F.lit(1).alias("label"), F.array(F.lit(1.0), F.lit(-2.0), F.lit(-0.0)).alias("embedding"))
    more = spark.createDataFrame([(1, 1, [1.0, -2.0, 0.01]), (2, 1, [1.0, 2.0, 0.0]), (3, 2, [1.0, -2.0, 0.0]), (3, 2, [2.0, -4.0, 0.0])], "vec_id long, label int, embedding array<double>")
    got = caps.link(table.unionByName(more), Kept(spark))
    assert {tuple(r) for r in got.filter("vec_id >= 5").groupBy("n_links", "component_id", "kept").count().collect()} == {(20_000, 1, False, 20_000)}
    rest = sorted(tuple(r) for r in got.filter("vec_id < 5").collect())
    assert rest == [(1, 20_000, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True)]


def test_neighbours_found(spark):
    rows = some_vectors(2, 500)
    table = spark.createDataFrame(rows, "id long, embedding array<double>, label int").select("id", "embedding")
    got = nn_descent.search(table, table.filter("id % 20 = 0"), 20, Kept(spark)).collect()
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and i not in range(1000, 1005) and i != 1006]
    hit = total = 0
    for q in (i for i, _ in good if i % 20 == 0):
        v = dict(good)[q]
        best = sorted((-(v @ w), i) for i, w in good if i != q)[:20]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and all(s == pytest.approx(v @ dict(good)[i], abs=1e-12) for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({m[1] for m in mine} & {b[1] for b in best})
        total += 20
    assert hit / total >= 0.9 and {r.query_id for r in got} == {i for i, _ in good if i % 20 == 0}


def test_of_many_copies_the_smallest_ids(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [2.0, 0.5, 0.0]) for i in rng.permutation(300)[:100]]
    taken = {i for i, _ in rows}
    rows += [(1000 + i, (rng.standard_normal(3) * 0.3).tolist()) for i in range(50)] + [(1000, [9.0, 9.0, 9.0]), (2000, [-2.0, 0.5, -0.0]), (2001, [-2.0, 0.5, 0.0])]
    table = spark.createDataFrame(rows, "id long, embedding array<double>").withColumn("vector", F.lit(1)).repartition(4)
    asked = sorted(taken)[::10] + [1003, 2000]
    got = nn_descent.search(table, table.filter(F.col("id").isin(asked)), 20, Kept(spark)).collect()
    vectors = {}
    for i, v in sorted(rows, key=lambda r: (r[0], np.array(r[1]).tobytes())):  # of repeated ids the last
        vectors[i] = np.array(v)
    for q in asked:
        best = sorted((-float(vectors[q] @ v), i) for i, v in vectors.items() if i != q)[:20]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == [b[1] for b in best] and [m[0] for m in mine] == list(range(1, 21))


def test_recall_with_copies(spark):
    """Several blocks of vectors, a fifth of them copies: by ids, of exact neighbours in double precision."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 24))
    x[3200:] = x[rng.integers(0, 800, 800)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>").repartition(4)
    got = nn_descent.search(table, table.filter("id % 20 = 0"), 20, Kept(spark)).toPandas()
    hits = 0
    for q in range(0, 4000, 20):
        score = x @ x[q]
        best = [i for i in np.lexsort((np.arange(4000), -score)) if i != q][:20]
        hits += len(set(best) & set(got.vec_id[got.query_id == q]))
    assert len(got) == 200 * 20 and hits / (200 * 20) >= 0.9


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [1.0, 0.0]), (4, None)], "id long, embedding array<double>")
    got = nn_descent.search(few, few.filter("id % 20 = 0"), 20, Kept(spark)).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(20, 1, 1, 1.0), (20, 2, 3, 1.0), (20, 3, 2, 0.5)]
    assert nn_descent.search(few.limit(0), few.limit(0), 20, Kept(spark)).count() == 0


@pytest.mark.parametrize("odd", [[None], [7.0], [0.0, 0.0, 0.0], [float("nan")] * 3])
def test_invalid_and_short_vectors_first(spark, odd):
    """Whatever row comes first, vectors of the most frequent length are searched."""
    rows = [(100 + i, odd) for i in range(2)] + [(i, [1.0, i / 10]) for i in range(1, 6)]
    table = spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1)
    got = nn_descent.search(table, table.filter("id IN (1, 100)"), 2, Kept(spark)).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(1, 5), (1, 4)]


def test_of_two_lengths_as_frequent_the_larger(spark):
    rows = [(1, [1.0]), (2, [2.0]), (3, [1.0, 1.0]), (4, [2.0, 1.0]), (5, [None, None]), (None, [1.0])]
    table = spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1)
    assert nn_descent._dimension(table) == 2 and nn_descent._dimension(table.limit(0)) == 1


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = components.components(spark.createDataFrame(links, "a long, b long"), Kept(spark)).collect()
    assert {r.node: r.least for r in got} == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


# --- models ------------------------------------------------------------------


@pytest.mark.parametrize("table, chunk", [(0, 1 << 20), (3, 60), (7, 300), (1 << 16, 1), (1 << 16, 1 << 22)])
def test_losses_count_every_word(spark, monkeypatch, table, chunk):
    """Words without an id in the broadcast table are counted by their hashes, as all others, and
    however texts are cut into chunks."""
    monkeypatch.setattr(cross_entropy, "DENSE", 4)
    monkeypatch.setattr(cross_entropy, "TABLE", table)
    monkeypatch.setattr(cross_entropy, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(cross_entropy, "BUCKET_ENTRIES", 100)
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(40)], weights=[1 / (i + 1) for i in range(40)], k=rng.randint(1, 15))) for _ in range(80)]
    rows = [*enumerate(texts), (3, texts[3]), (4, "other words W1"), (100, None), (None, "w0 rare"), (101, " \n "), (102, "w1 " * 3000 + "last"), (None, None)]
    target = texts[:25] + ["never seen w0 w1 never seen"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("chunk", "n", "ids")}).repartition(4)
    got = cross_entropy.score(docs, spark.createDataFrame([(t,) for t in target], "text string"), Kept(spark)).collect()
    different = len({w for _, t in rows for w in (t or "").lower().split()}) + 2

    def model(corpus):
        single, context, pair = Counter(), Counter(), Counter()
        for text in corpus:
            w = (text or "").lower().split()
            for a, b in zip(["<"] + w, w):
                single[b] += 1
                context[a] += 1
                pair[a, b] += 1
        total = sum(single.values())
        return lambda a, b: -math.log((pair[a, b] + 50 * (single[b] + 1) / (total + different)) / (context[a] + 50))

    models, want = (model(target), model([t for _, t in rows])), []
    for doc, text in rows:
        w = (text or "").lower().split()
        want.append((doc, len(w), *([sum(m(a, b) for a, b in zip(["<"] + w, w)) / len(w) for m in models] if w else [None, None])))
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    mine = sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in got), key=key)
    assert len(mine) == len(want)
    for a, b in zip(mine, sorted(want, key=key)):
        assert a[:2] == b[:2] and (a[2:] == b[2:] or a[2:] == pytest.approx(b[2:]))


def test_losses_of_nothing_and_under_no_target(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    none = docs.select("text").limit(0)
    assert cross_entropy.score(docs.limit(0), none, Kept(spark)).count() == 0
    got = {r.doc_id: r for r in cross_entropy.score(docs, none, Kept(spark)).collect()}
    # two words, the place before a text, and the unknown word share the unigram probability
    assert got[1].target_loss == pytest.approx(math.log(4)) and (got[2].n_tokens, got[2].score) == (0, None)


@pytest.mark.parametrize("chunk", [1, 60, 1 << 20])
def test_a_target_of_ids_is_that_of_its_texts(spark, monkeypatch, chunk):
    monkeypatch.setattr(cross_entropy, "DENSE", 4)
    monkeypatch.setattr(cross_entropy, "TABLE", 3)
    monkeypatch.setattr(cross_entropy, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(cross_entropy, "BUCKET_ENTRIES", 20)
    rows = [(i, f"w{i % 5} a b w{i % 7} rare{i} b") for i in range(40)] + [(3, "a again"), (3, "a again"), (50, None), (None, "a b"), (51, "")]
    docs, good = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), [3, 5, 17, 50, 51, 99, None]
    ids = spark.createDataFrame([(i,) for i in good], "doc_id int")
    texts = spark.createDataFrame([(t,) for i, t in rows if i is not None and i in good], "text string")
    key = lambda r: (str(r[0]), r[1], r[2] or 0)
    by_id, by_text = (sorted(map(tuple, cross_entropy.score(docs, x, Kept(spark)).collect()), key=key) for x in (ids, texts))
    assert len(by_id) == len(rows)
    for a, b in zip(by_id, by_text, strict=True):
        assert a[:2] == b[:2] and (a[2:] == b[2:] or a[2:] == pytest.approx(b[2:]))


def test_a_packet_names_a_hashed_word_once():
    rng = np.random.default_rng(3)
    words = rng.integers(1 << 62, 1 << 63, 5000).astype(np.uint64) | cross_entropy._HASHED
    ids = rng.integers(2, 60000, 5000).astype(np.uint64)
    text = np.stack([ids, words], 1).ravel()  # each hashed word stands once after an id and once before another
    before = np.append(np.uint64(1), text[:-1])
    asked, everything = cross_entropy.Asked(before, text, np.zeros(len(text), np.int64), 4, 7), np.ones(1, bool)
    packets = list(asked.packets(zstandard.ZstdCompressor(level=1), (~everything, everything)))
    assert len(packets) == 7 and sum(n for _, _, n in packets) == 10000 + 4999
    assert sum(len(raw) for _, raw, _ in packets) < 5000 * 8 + 10000 * 3.5
    head, beside, target, background = cross_entropy._entries(zstandard.ZstdDecompressor().decompress(packets[0][1]), packets[0][2])
    mine = asked.bucket == packets[0][0]
    assert (head == asked.head[mine]).all() and (beside == asked.beside[mine]).all() and not target.any() and background.sum() == len(head)


def graded_texts(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2])
        w = [f"n{rng.randrange(300)}" for _ in range(rng.randint(20, 200))]
        for _ in range({0: 6, 1: 3, 2: 0}[grade]):
            w.insert(rng.randrange(len(w)), rng.choice(["awful", "nasty", "vile"]) if grade == 0 else rng.choice(["meh", "dull"]))
        out.append((seed * 10000 + i, " ".join(w), grade))
    return out


def test_held_out_grades(spark):
    known, fresh = graded_texts(1, 700), graded_texts(2, 200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in known], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in known], "doc_id long, grade int")
    model = ordinal.train(docs, ratings)
    assert model.thresholds[0] < model.thresholds[1]
    table = spark.createDataFrame([(i, t, 1) for i, t, _ in fresh], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in ordinal.grade(table, model).collect()}
    assert sum((got[i].tail_probability >= 0.5) == (g == 2) for i, _, g in fresh) / len(fresh) > 0.95
    # the production rule: hardly any good text goes, hardly any bad one stays
    share = [np.mean([got[i].kept for i, _, g in fresh if g == k]) for k in range(3)]
    assert share[0] < 0.1 and share[2] > 0.97
    means = [np.mean([got[i].expected_grade for i, _, g in fresh if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    again = ordinal.train(docs.repartition(7), ratings.repartition(3))
    assert np.array_equal(again.weights, model.weights)
    # without evidence against them, short and unfamiliar texts stay
    strange = [(i, t) for i, t in enumerate(["hello", "n1", "n2 n3", "Всё новое слово", "unseen words in a short text", "日本語"] + [f"q{i} z{i}" for i in range(20)])]
    kept = ordinal.grade(spark.createDataFrame(strange, "doc_id long, text string"), model)
    assert kept.filter("kept").count() == len(strange)


def test_one_text_of_a_rated_id_is_fitted(spark):
    """16,384 ratings at most, one row for each id, and repeated rows change nothing."""
    assert ordinal.SAMPLE_ROWS == 16384
    known = graded_texts(3, 120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in known], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, _, g in known], "doc_id long, grade int")
    model = ordinal.train(docs, ratings)
    more = docs.unionByName(docs).unionByName(docs.withColumn("text", F.lit("")))
    again = ordinal.train(more, ratings.unionByName(ratings))
    assert model.weights.any() and np.array_equal(again.weights, model.weights)
    few = ordinal.train(docs, ratings, sample_rows=1)
    assert not few.weights.any()


def test_telling_features_are_those_of_plain_counts(spark):
    rng = np.random.default_rng(4)
    lists = [np.unique(rng.integers(0, 60, rng.integers(0, 20))).tolist() for _ in range(300)]
    grades = [2 - min(2, sum(x < 4 for x in row)) for row in lists]
    rows = spark.createDataFrame(list(zip(range(300), grades, lists)), "doc_id long, grade int, number array<int>").repartition(3)
    want = []
    for f in range(60):
        here = [g for g, x in zip(grades, lists) if f in x]
        for cut in (0, 1):
            share = sum(g <= cut for g in grades) / 300
            if len(here) >= 8 and abs(sum(g <= cut for g in here) - share * len(here)) > 4 * math.sqrt(share * (1 - share) * len(here)):
                want.append(f)
    assert want and ordinal.telling(rows, np.bincount(grades, minlength=3), 8, 4.0).tolist() == sorted(set(want))


def ordinal_loss(weights, cuts, lists, grades, ridge):
    """Mean negative log likelihood of the cumulative-link model, written out, and the ridge."""
    total = 0.0
    for features, grade in zip(lists, grades):
        strength = sum(weights[f] for f in features)
        upto = [0.0, *(1 / (1 + math.exp(strength - c)) for c in cuts), 1.0]
        total -= math.log(upto[grade + 1] - upto[grade])
    return total / len(grades) + ridge / 2 * sum(w * w for w in weights)


def test_fit_is_the_likelihood_maximum_of_brute_force():
    """Against a plain coordinate search over all weights and thresholds on small random data."""
    rng = random.Random(11)
    lists = [[f for f in range(4) if rng.random() < 0.5] for _ in range(60)]
    grades = np.array([min(3, max(0, (0 in x) + 2 * (1 in x) - (2 in x) + rng.choice([0, 0, 1]))) for x in lists])
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    model = ordinal.fit(np.array(sum(lists, [])), first, grades, 4, rounds=3000, ridge=0.02, rate=0.01)
    point, step = [0.0] * 4 + [-1.0, 0.0, 1.0], 0.5

    def loss(p):
        return ordinal_loss(p[:4], p[4:], lists, grades, 0.02) if p[4] < p[5] < p[6] else math.inf

    best = loss(point)
    while step > 1e-5:
        moved = False
        for k in range(7):
            for change in (-step, step):
                trial = [*point]
                trial[k] += change
                if (now := loss(trial)) < best - 1e-12:
                    point, best, moved = trial, now, True
        step = step if moved else step / 2
    assert np.allclose(model.weights[:4], point[:4], atol=2e-3) and np.allclose(model.thresholds, point[4:], atol=2e-3)
    assert not model.weights[4:].any()
    chances = np.diff(np.concatenate([[0], model.at_most(np.zeros(1))[0], [1]]))
    assert chances.sum() == pytest.approx(1) and (chances > 0).all()


def test_odd_texts_and_no_ratings(spark):
    table = spark.createDataFrame([(1, None), (2, ""), (3, "x " * 50000), (None, "a"), (2, "")], "doc_id long, text string")
    none = ordinal.graded(spark.createDataFrame([(1, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    got = ordinal.grade(table, ordinal.train(table, none)).collect()
    assert len(got) == 5 and all(0 <= r.tail_probability <= 1 for r in got)
    assert ordinal.grade(table.limit(0), ordinal.train(table, none)).count() == 0


def test_stage_tables_go_to_the_shared_folder(spark):
    assert stages.stage_folder(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
