"""Approximate nearest neighbours: a graph by NN-descent, and greedy search in it.

Nearness is the largest inner product. For the graph vectors get one more component that
gives all the same length, under which the order by inner product is that of distances; the
search compares queries, with that component 0, and final scores use the original vectors in
double precision.

Equal vectors are one vertex: the graph and the search have distinct vectors only, and a
vertex found stands for its ids. A result needs no more than the k + 1 smallest of them.

Building: the first neighbours come from blocks of a few random-hyperplane codes. Then, in
each round, every vertex brings its neighbours and the vertices whose neighbour it is
together, and new pairs of them become each other's candidates; a vertex keeps its best. The
meeting lists of a vertex are bounded by the method (a random sample of those that point to
it), so vertices that very many point to stay cheap. Rounds end when few lists change, after
as many as that takes.

Searching: each distinct query vector starts from its own vertex, if it is one, and some fixed
entry points. In every round the neighbours of its best vertices not yet expanded are scored;
it keeps a beam of the best. The search of a query ends when all of its beam is expanded.
Candidates go to buckets of vertices, and answers back to groups of queries, in packed rows
that hold all that one has for the other, so rows do not grow with queries times buckets.
Each round's lists and beams are written.

Every vector is indexed. Defined results: vectors that are null, empty, zero or hold null or
non-finite components, and vectors of another length than most valid ones have (the larger of
two as frequent), take no part; neither do null ids; of equal scores the smaller id comes
first; rows that repeat an id are one vector, the last of the sorted ones; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from staffcast.llm.caps import vectors
from staffcast.llm.words import mix

NEIGHBOURS = 32
POINTING = 32  # vertices that point to one, met in a round
CODES = 6
BLOCK = 384
BEAM, EXPAND = 160, 32  # vertices that a query keeps, and expands in a round
GROUP_QUERIES, BUCKET_VERTICES, LEAST_BUCKETS = 256, 2000, 8
_SAME = 0.02  # rounds end when a smaller part of all list entries is new


def _dimension(table: DataFrame) -> int:
    """The most frequent length of valid vectors, the larger of two as frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = []
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                values, ok = vectors(part.column(1))
                lengths += [len(values[i]) for i in np.flatnonzero(ok & np.array(part.column(0).is_valid()))]
            length, n = np.unique(np.array(lengths, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length), pa.array(n.astype(np.int64))], names=["length", "n"])

    counts = table.mapInArrow(run, "length long, n long").groupBy("length").agg(F.sum("n").alias("n"))
    return counts.agg(F.max_by("length", F.struct("n", "length"))).first()[0] or 1


def _valid(table: DataFrame, dim: int) -> DataFrame:
    """id and packed doubles of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                values, ok = vectors(part.column(1))
                rows = [i for i in np.flatnonzero(ok & np.array(part.column(0).is_valid())) if len(values[i]) == dim]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array([(values[i] + 0.0).tobytes() for i in rows], pa.binary())],
                    names=["id", "vector"])

    return table.mapInArrow(run, "id long, vector binary").groupBy("id").agg(F.max("vector").alias("vector"))


def _matrix(column, dtype=np.float64) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=dtype).reshape(len(rows), -1) if rows else np.zeros((0, 0), dtype)


def _best(owner: np.ndarray, other: np.ndarray, score: np.ndarray, most: int, *more: np.ndarray):
    """Of rows (owner, other, score) each owner's `most` best different others, owners ascending."""
    order = np.lexsort((other, owner))
    keep = order[np.append(True, (owner[order][1:] != owner[order][:-1]) | (other[order][1:] != other[order][:-1]))] if len(order) else order
    order = keep[np.lexsort((other[keep], -score[keep], owner[keep]))]
    o = owner[order]
    order = order[np.arange(len(o)) - np.searchsorted(o, o) < most]
    return (owner[order], other[order], score[order], *(m[order] for m in more))


def _pack(owner, *lists) -> list[tuple]:
    """Rows of one owner as packed lists; owners ascending."""
    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    stop = np.append(begin[1:], len(owner)) if len(owner) else begin
    return [(int(owner[a]), *(x[a:b].tobytes() for x in lists)) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate(zip(names, kinds, strict=True))})


def _buckets(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))


def _first_lists(points: DataFrame, n: int, neighbours: int, keep) -> DataFrame:
    """Lists from blocks of points with equal signs on random hyperplanes; large blocks are split."""
    bits = max(0, int(np.ceil(np.log2(max(1, n) / BLOCK))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), np.float16).astype(np.float32)
            for c in range(CODES if bits else 1):
                planes = np.random.default_rng([7, c]).standard_normal((x.shape[1], bits)) if len(x) else np.zeros((0, 0))
                signs = ((x @ planes > 0) << np.arange(bits)).sum(axis=1) if len(x) and bits else np.zeros(len(x), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signs.astype(np.int64) * CODES + c), batch.column(0), batch.column(1)], names=["code", "id", "point"])

    coded = keep(points.mapInArrow(code, "code long, id long, point binary"), "coded")
    sizes = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).cast("int").alias("parts"))
    dealt = coded.join(sizes, "code").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))

    def compare(part: pa.Table) -> pa.Table:
        ids = part.column("id").to_numpy()
        x = _matrix(part.column("point"), np.float16).astype(np.float32)
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        most = min(neighbours, len(ids) - 1)
        if most < 1:
            return _table([], ["id", "others", "scores"], [pa.int64(), pa.binary(), pa.binary()])
        top = np.argpartition(-s, most - 1, axis=1)[:, :most]
        rows = [(int(ids[i]), ids[top[i]].tobytes(), s[i, top[i]].tobytes()) for i in range(len(ids))]
        return _table(rows, ["id", "others", "scores"], [pa.int64(), pa.binary(), pa.binary()])

    return dealt.groupBy("code", "part").applyInArrow(compare, "id long, others binary, scores binary")


def _merge(neighbours: int):
    """Joins old lists (flag set) and candidates of the vertices of a bucket; marks new entries."""

    def run(part: pa.Table) -> pa.Table:
        ids, olds = part.column("id").to_numpy(), part.column("old").to_numpy().astype(bool)
        others = [np.frombuffer(x, np.int64) for x in part.column("others").to_pylist()]
        size = [len(x) for x in others]
        owner, other = np.repeat(ids, size), np.concatenate(others)
        score = np.frombuffer(b"".join(part.column("scores").to_pylist()), np.float32)
        new = ~np.repeat(olds, size)
        first = np.argsort(new, kind="stable")  # an old entry stays before the same as candidate
        owner, other, score, new = owner[first], other[first], score[first], new[first]
        owner, other, score, new = _best(owner, other, score, neighbours, new)
        rows = _pack(owner, other, score, new.astype(np.uint8))
        rows = [(*r, int(np.frombuffer(r[3], np.uint8).sum())) for r in rows]
        return _table(rows, ["id", "others", "scores", "fresh", "n_fresh"], [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()])

    return run


_LISTS = "id long, others binary, scores binary, fresh binary, n_fresh long"


def _meet(part: pa.Table) -> pa.Table:
    """Pairs of the members of each centre, at least one of them fresh, as candidates that beat a
    member's worst neighbour."""
    centre, member = part.column("centre").to_numpy(), part.column("member").to_numpy()
    fresh, worst = part.column("fresh").to_numpy().astype(bool), part.column("worst").to_numpy()
    x = _matrix(part.column("point"), np.float16).astype(np.float32)
    order = np.lexsort((~fresh, member, centre))
    order = order[np.append(True, (centre[order][1:] != centre[order][:-1]) | (member[order][1:] != member[order][:-1]))]
    centre, member, fresh, worst, x = centre[order], member[order], fresh[order], worst[order], x[order]
    bounds = np.flatnonzero(np.append(np.append(True, centre[1:] != centre[:-1]), True))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a < 2 or not fresh[a:b].any():
            continue
        s = x[a:b] @ x[a:b].T
        good = (s > worst[a:b, None]) & (fresh[a:b, None] | fresh[None, a:b])
        np.fill_diagonal(good, False)
        p, q = np.nonzero(good)
        out.append((member[a + p], member[a + q], s[p, q]))
    names, kinds = ["id", "others", "scores"], [pa.int64(), pa.binary(), pa.binary()]
    if not out:
        return _table([], names, kinds)
    owner, other, score = (np.concatenate(c) for c in zip(*out, strict=True))
    owner, other, score = _best(owner, other, score, NEIGHBOURS)
    return _table(_pack(owner, other, score), names, kinds)


def _entries(lists: DataFrame) -> DataFrame:
    """(id, other, fresh, place) for every list entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            size = [len(x) for x in others]
            flat = np.concatenate(others) if others else np.zeros(0, np.int64)
            fresh = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), size)), pa.array(flat), pa.array(fresh.astype(bool))], names=["id", "other", "fresh"])

    return lists.select("id", "others", "fresh").mapInArrow(run, "id long, other long, fresh boolean")


def build(points: DataFrame, n: int, n_buckets: int, keep) -> DataFrame:
    """Neighbour lists of all points (id, packed half-precision point)."""

    def merged(candidates: DataFrame, old: DataFrame | None) -> DataFrame:
        rows = candidates.select("id", "others", "scores", F.lit(False).alias("old"))
        if old is not None:
            rows = rows.unionByName(old.select("id", "others", "scores", F.lit(True).alias("old")))
        return _buckets(rows, n_buckets, "id").groupBy("bucket").applyInArrow(_merge(NEIGHBOURS), _LISTS)

    lists = keep(merged(_first_lists(points, n, NEIGHBOURS, keep), None), "lists")
    for step in itertools.count():
        entries = _entries(lists)
        pointing = entries.select(F.col("other").alias("centre"), F.col("id").alias("member"), "fresh")
        sample = F.row_number().over(_window(step)) <= POINTING
        pointing = pointing.withColumn("in", sample).filter("in").drop("in")
        members = entries.select(F.col("id").alias("centre"), F.col("other").alias("member"), "fresh").unionByName(pointing)
        known = _worst(points.join(lists.select("id", "scores"), "id", "left"))
        met = members.join(known, F.col("member") == F.col("id")).select("centre", "member", "fresh", "worst", "point")
        found = _buckets(met, n_buckets, "centre").groupBy("bucket").applyInArrow(_meet, "id long, others binary, scores binary")
        lists = keep(merged(found, lists), "lists")
        changed = lists.agg(F.sum("n_fresh")).first()[0] or 0
        if changed <= _SAME * n * NEIGHBOURS:
            break
    return lists


def _window(step: int):
    return Window.partitionBy("centre").orderBy(F.xxhash64("centre", "member", F.lit(step)))


def _worst(rows: DataFrame) -> DataFrame:
    """id, point and the score that a candidate must beat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = batch.column(2).to_pylist()
            worst = [np.frombuffer(s, np.float32).min() if s and len(s) >= 4 * NEIGHBOURS else -np.inf for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(worst, pa.float32())], names=["id", "point", "worst"])

    return rows.select("id", "point", "scores").mapInArrow(run, "id long, point binary, worst float")


def _place(ids: np.ndarray, n: int) -> np.ndarray:
    """The bucket or group of ids."""
    return (mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int64)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    bounds = np.flatnonzero(np.append(np.append(True, keys[1:] != keys[:-1]), True)) if len(keys) else np.zeros(1, np.int64)
    return list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))


_SENT = "bucket long, queries binary, counts binary, vectors binary, nodes binary"


def _send(n_buckets: int):
    """Rows (query, vector, others) as packets for the buckets of the others: queries, how many
    nodes each asks for, their vectors, and the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, vector = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            lists = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            node = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            bucket = _place(node, n_buckets)
            order = np.lexsort((node, query[row], bucket))
            bucket, row, node = bucket[order], row[order], node[order]
            out = []
            for a, b in _runs(bucket):
                asks = query[row[a:b]]
                new = np.append(True, (asks[1:] != asks[:-1]) | (node[a + 1 : b] != node[a : b - 1]))
                nodes, asks, at = node[a:b][new], asks[new], row[a:b][new]
                spans = _runs(asks)
                first = [at[i] for i, _ in spans]
                out.append((int(bucket[a]), query[first].tobytes(), np.array([j - i for i, j in spans]).tobytes(), b"".join(vector[i] for i in first), nodes.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), *[pa.binary()] * 4))], names=["bucket", "queries", "counts", "vectors", "nodes"])

    return run


def _score(n_groups: int):
    """Scores of the nodes that packets ask for against a bucket's vectors, packed for groups of queries."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        names, kinds = ["group", "queries", "others", "scores"], [pa.int64(), *[pa.binary()] * 3]
        if not asked.num_rows or not held.num_rows:
            return _table([], names, kinds)
        ids = held.column("id").to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], _matrix(held.column("vector"))[order]
        flat = {c: np.frombuffer(b"".join(asked.column(c).to_pylist()), np.int64) for c in ("queries", "counts", "nodes")}
        vector = np.frombuffer(b"".join(asked.column("vectors").to_pylist()), np.float64).reshape(-1, x.shape[1])
        source = np.repeat(np.arange(len(flat["queries"])), flat["counts"])
        query, node = flat["queries"][source], flat["nodes"]
        order = np.lexsort((node, query))
        order = order[np.append(True, (query[order][1:] != query[order][:-1]) | (node[order][1:] != node[order][:-1]))]
        source, query, node = source[order], query[order], node[order]
        at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
        known = ids[at] == node
        source, query, node, at = source[known], query[known], node[known], at[known]
        score = np.empty(len(node))
        for a, b in _runs(query):
            score[a:b] = x[at[a:b]] @ vector[source[a]]
        group = _place(query, n_groups)
        order = np.argsort(group, kind="stable")
        group, query, node, score = group[order], query[order], node[order], score[order]
        return _table([(int(group[a]), query[a:b].tobytes(), node[a:b].tobytes(), score[a:b].tobytes()) for a, b in _runs(group)], names, kinds)

    return run


_BEAMS = "group long, query long, vector binary, others binary, scores binary, done binary, next binary"


def _advance(beam: int, expand: int):
    """Joins the beams of a group of queries (seen ids, scores, flags of expansion) and their newly
    scored vertices; gives the new beams and the vertices to expand next."""

    def run(states: pa.Table, answers: pa.Table) -> pa.Table:
        names, kinds = [f.split()[0] for f in _BEAMS.split(", ")], [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        if not states.num_rows:
            return _table([], names, kinds)
        group, ids = states.column("group")[0].as_py(), states.column("query").to_numpy()
        vector = dict(zip(ids.tolist(), states.column("vector").to_pylist(), strict=True))
        old = {c: states.column(c).to_pylist() for c in ("others", "scores", "done")}
        size = [len(x) // 8 for x in old["others"]]
        flat = {c: b"".join(answers.column(c).to_pylist()) for c in ("queries", "others", "scores")}
        owner = np.concatenate([np.repeat(ids, size), np.frombuffer(flat["queries"], np.int64)])
        other = np.frombuffer(b"".join(old["others"]) + flat["others"], np.int64)
        score = np.frombuffer(b"".join(old["scores"]) + flat["scores"], np.float64)
        done = np.zeros(len(owner), np.uint8)
        done[: sum(size)] = np.frombuffer(b"".join(old["done"]), np.uint8)
        owner, other, score, done = _best(owner, other, score, beam, done)
        waiting = np.flatnonzero(done == 0)
        w = owner[waiting]
        go = waiting[np.arange(len(w)) - np.searchsorted(w, w) < expand]
        next_ = {int(r[0]): r[1] for r in _pack(owner[go], other[go])}
        done = done.copy()
        done[go] = 1
        found = {r[0]: r[1:] for r in _pack(owner, other, score, done)}
        rows = [(group, q, vector[q], *found.get(q, (b"", b"", b"")), next_.get(q)) for q in ids.tolist()]
        return _table(rows, names, kinds)

    return run


def search(table: DataFrame, queries: DataFrame, k: int, keep) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for rows (id, embedding) of `queries`
    among rows (id, embedding) of `table`, a query's own id excepted."""
    spark = table.sparkSession
    dim = _dimension(table)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = keep(_valid(table, dim).withColumn("digest", F.md5("vector")), "base")
    alike = base.withColumn("place", F.row_number().over(Window.partitionBy("digest").orderBy("id"))).filter(F.col("place") <= k + 1)
    vertices = keep(alike.groupBy("digest").agg(
        F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"), F.any_value("vector").alias("vector")), "vertices")
    wanted = keep(_valid(queries, dim).select(F.col("id").alias("query_id"), F.md5("vector").alias("digest"), "vector"), "wanted")
    asked = keep(wanted.groupBy("digest").agg(F.min("query_id").alias("query"), F.any_value("vector").alias("vector")), "asked")
    n, n_asked = vertices.count(), asked.count()
    longest = _norms(vertices).agg(F.max("norm")).first()[0] or 1.0
    points = keep(_points(vertices, longest), "points")
    n_buckets = max(2 * parts, -(-n // BUCKET_VERTICES))
    n_groups = max(1, -(-n_asked // GROUP_QUERIES))
    lists = build(points, n, n_buckets, keep)
    # a vertex leads to its neighbours and to a sample of those that point to it
    entries = _entries(lists)
    back = entries.select(F.col("other").alias("centre"), F.col("id").alias("member"))
    back = back.withColumn("place", F.row_number().over(_window(99))).filter(F.col("place") <= POINTING).drop("place")
    ways = entries.select(F.col("id").alias("centre"), F.col("other").alias("member")).union(back)
    graph = keep(_buckets(ways, n_buckets, "centre").groupBy("bucket").applyInArrow(_adjacent, "id long, others binary"), "graph")
    # packets go from every task to every bucket, so these follow the vertices, not the partitions
    n_places = max(LEAST_BUCKETS, -(-n // BUCKET_VERTICES))
    placed = keep(_placed(vertices.select("id", "vector"), "id", n_places, "bucket"), "placed")

    # entry points: the query's own vertex, if it is one, and some fixed vertices
    fixed = points.select("id").orderBy(F.xxhash64("id")).limit(EXPAND)
    start = keep(fixed.agg(F.collect_list("id").alias("ids")), "entries").first().ids
    own = asked.join(vertices.select("digest", F.col("id").alias("own")), "digest", "left")
    none = F.lit(b"")
    state = keep(_placed(own.select("query", "vector", "own"), "query", n_groups, "group"), "beam")
    ask = state.select("query", "vector", F.array_compact(F.array("own", *[F.lit(int(i)) for i in start])).alias("nodes"))
    ask = _listed(ask)
    state = state.select("group", "query", "vector", none.alias("others"), none.alias("scores"), none.alias("done"), none.alias("next"))
    while True:
        sent = ask.mapInArrow(_send(n_places), _SENT)
        scored = sent.groupBy("bucket").cogroup(placed.groupBy("bucket")).applyInArrow(
            _score(n_groups), "group long, queries binary, others binary, scores binary")
        state = keep(state.groupBy("group").cogroup(scored.groupBy("group")).applyInArrow(_advance(max(BEAM, 2 * k), EXPAND), _BEAMS), "beam")
        if not state.filter("next IS NOT NULL").take(1):
            break
        frontier = _flat(state.filter("next IS NOT NULL").select("query", "vector", F.col("next").alias("others")))
        ask = frontier.join(graph, F.col("node") == F.col("id")).select("query", "vector", "others")

    # the best ids of each distinct query; its own id may be one more than asked for
    found = state.select("query", "others", "scores").mapInArrow(_top(k + 1), "query long, id long, score double")
    ids = found.join(vertices.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = ids.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    best = keep(best.join(asked.select("query", "digest"), "query").select("digest", "place", "vec_id", "score"), "best")
    mine = wanted.select("query_id", "digest").join(best, "digest").filter("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("place"))
    return mine.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _norms(base: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.linalg.norm(x, axis=1) if len(x) else np.zeros(0))], names=["norm"])

    return base.select("vector").mapInArrow(run, "norm double")


def _points(base: DataFrame, longest: float) -> DataFrame:
    """Vectors over the greatest length, with the component that fills them up to length 1."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1)) / longest
            fill = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1))) if len(x) else np.zeros(0)
            points = np.column_stack([x, fill]).astype(np.float16) if len(x) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p.tobytes() for p in points], pa.binary())], names=["id", "point"])

    return base.select("id", "vector").mapInArrow(run, "id long, point binary")


def _adjacent(part: pa.Table) -> pa.Table:
    centre, member = part.column("centre").to_numpy(), part.column("member").to_numpy()
    order = np.lexsort((member, centre))
    order = order[np.append(True, (centre[order][1:] != centre[order][:-1]) | (member[order][1:] != member[order][:-1]))]
    return _table(_pack(centre[order], member[order]), ["id", "others"], [pa.int64(), pa.binary()])


def _placed(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """The rows with the bucket or group of a column of ids."""
    schema = rows.withColumn(name, F.lit(None).cast("long")).schema
    at = rows.columns.index(key)

    def run(batches):
        for batch in batches:
            place = _place(np.ascontiguousarray(batch.column(at).to_numpy(zero_copy_only=False)), n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _listed(rows: DataFrame) -> DataFrame:
    """Rows (query, vector, nodes) with the array of nodes as a packed list."""

    def run(batches):
        for batch in batches:
            packed = [np.array(x, np.int64).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["query", "vector", "others"])

    return rows.mapInArrow(run, "query long, vector binary, others binary")


def _flat(rows: DataFrame) -> DataFrame:
    """(query, vector, node) for packed lists (query, vector, others)."""

    def run(batches):
        for batch in batches:
            lists = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            row = pa.array(np.repeat(np.arange(len(lists)), [len(x) for x in lists]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(flat)], names=["query", "vector", "node"])

    return rows.mapInArrow(run, "query long, vector binary, node long")


def _top(k: int):
    """Each query's k best vertices (query, id, score)."""

    def run(batches):
        for batch in batches:
            out = []
            for query, others, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                o, s = np.frombuffer(others, np.int64), np.frombuffer(scores, np.float64)
                best = np.lexsort((o, -s))[:k]
                out.append((np.full(len(best), query), o[best], s[best]))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, (np.int64, np.int64, np.float64), strict=True)],
                                             names=["query", "id", "score"])

    return run
