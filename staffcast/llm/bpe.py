"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are cut into pieces by a pattern. A piece that is a token as a whole is that token;
every other piece starts as its bytes, one matrix row each, in matrices of similar lengths.
Each round every row merges its leftmost pair of least rank: the ranks of pairs are kept
beside the ids, a hash table gives the ranks of the two new neighbours, and the row closes up
behind the merge. Rows without a pair in the table are done and leave the matrix.

Ids travel as packed little-endian unsigned 32-bit integers, the layout of flat token files.

Defined results: a null text is empty and gives no ids; empty packed ids decode to no bytes;
null packed ids likewise; repeated rows are encoded alike; an empty table gives an empty
result; all columns of the input are kept, and a column named as an output is replaced.

Spark gives a task one Python worker for each Python step of its stage, and workers live on.
`encode_and_decode` takes both steps in one worker, with one codec.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from staffcast.llm.words import chunks, span_hashes

KNOWN_PIECES = 1 << 19  # pieces remembered by a worker; beyond that it starts afresh
KNOWN_BYTES = 1 << 24  # of them all; few but long pieces fill a worker too
MATRIX_CELLS = 1 << 21
NO_RANK = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """The tokens and ranks of a rank file: base64 of the token's bytes, space, rank."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines)]


# Fixed value: the pattern that the cutter on whole arrays stands for; other patterns use a regex.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _DIGIT, _SPACE = range(4)


@functools.cache
def _kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, _OTHER, dtype=np.uint8)
    points = np.frombuffer(every.encode("utf-32-le"), dtype=np.uint32)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            out[points[run.start() : run.end()]] = kind
    return out


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the matches of WORD_PATTERN begin in the code points of consecutive texts that end at `ends`.

    Matches are runs of one kind, with these exceptions: a space before a run of another kind
    belongs to it; of several white spaces before something else the last stands apart; and an
    apostrophe that begins a match takes an English ending with it.
    """
    n = len(points)
    kind = _kinds()[points]
    edge = np.zeros(n + 1, dtype=bool)  # a text begins here
    edge[0] = edge[ends] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])  # white space before something else
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    quote = np.flatnonzero((points == 0x27) & start)
    if len(quote):
        text_end = ends[np.searchsorted(ends, quote, side="right")]
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one = np.where(quote + 1 < text_end, padded[quote + 1], 0)
        two = np.where(quote + 2 < text_end, padded[quote + 2], 0)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for taken, size in ((quote[single], 2), (quote[double], 3)):
            start[taken + 1] = False
            behind = taken + size
            start[behind[behind < n]] = True
    return np.flatnonzero(start)


class PairTable:
    """Open-addressing hash table from pairs of ids to the rank of their merge."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.bits, NO_RANK, dtype=np.int32)
        self.probes = 0
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            self.probes += 1
            free = left[self.ranks[slot[left]] == NO_RANK]
            self.keys[slot[free]] = keys[free]  # of several for a slot one stays
            won = free[self.keys[slot[free]] == keys[free]]
            self.ranks[slot[won]] = ranks[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NO_RANK where they don't merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.ranks[slot], NO_RANK)
        open_ = np.flatnonzero((held != keys) & (self.ranks[slot] != NO_RANK))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held, want = self.keys[slot[open_]], keys[open_]
            found = held == want
            out[open_[found]] = self.ranks[slot[open_[found]]]
            open_ = open_[~found & (self.ranks[slot[open_]] != NO_RANK)]
        return out


class Codec:
    """Encodes pieces with ranks and decodes ids; made once per worker."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str):
        self.ranks = dict(ranks)
        self.pattern = regex.compile(pattern)
        self.of_byte = np.full(256, -1, dtype=np.int64)
        for b in range(256):
            self.of_byte[b] = self.ranks.get(bytes([b]), -1)
        if (self.of_byte < 0).any():
            raise ValueError("the ranks must hold all single bytes")
        left, right, made = [], [], []
        for token, rank in ranks:
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(rank)
        keys = (np.array(left, dtype=np.uint64) << np.uint64(32)) | np.array(right, dtype=np.uint64)
        self.pairs = PairTable(keys, np.array(made, dtype=np.int32))
        size = max(self.ranks.values()) + 1
        lengths = np.zeros(size + 1, dtype=np.int64)
        for token, rank in ranks:
            lengths[rank + 1] = len(token)
        self.token_start = np.cumsum(lengths)
        self.token_bytes = np.frombuffer(b"".join(t for t, _ in sorted(ranks, key=lambda x: x[1])), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.known_bytes = 0
        self.start = np.zeros(1, dtype=np.int64)
        self.token = np.zeros(0, dtype=np.uint32)

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces not seen before and append them to the flat store of known ones."""
        raw = [p.encode() for p in pieces]
        self.known_bytes += sum(map(len, raw))
        whole = np.fromiter((self.ranks.get(p, -1) for p in raw), dtype=np.int64, count=len(raw))
        hard = np.flatnonzero(whole < 0)
        ids, lengths = self.merge([raw[i] for i in hard])
        sizes = np.ones(len(raw), dtype=np.int64)
        sizes[hard] = lengths
        ends = np.cumsum(sizes)
        flat = np.empty(int(ends[-1]), dtype=np.uint32)
        easy = np.flatnonzero(whole >= 0)
        flat[ends[easy] - 1] = whole[easy]
        flat[np.repeat(whole < 0, sizes)] = ids
        self.place.update(zip(pieces, range(len(self.place), len(self.place) + len(pieces)), strict=True))
        self.start = np.concatenate([self.start, self.start[-1] + ends])
        self.token = np.concatenate([self.token, flat])

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at least one byte, one after the other, and the number of each;
        merged in matrices of similar lengths."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(lengths, kind="stable")
        done_ids, done_rows, done_sizes = [], [], []
        at = 0
        while at < len(order):
            # rows up to a half longer than the first, and no more cells than the bound
            width = lengths[order[at]]
            stop = int(np.searchsorted(lengths[order], width + width // 2, side="right"))
            stop = max(at + 1, min(stop, at + int(MATRIX_CELLS // (width + width // 2 + 1))))
            rows = order[at:stop]
            for ids, live, sizes in self._merge_matrix([pieces[i] for i in rows], lengths[rows]):
                done_ids.append(ids), done_rows.append(rows[live]), done_sizes.append(sizes)
            at = stop
        if not done_rows:
            return np.zeros(0, np.uint32), lengths
        row, size = np.concatenate(done_rows), np.concatenate(done_sizes)
        back = np.empty(len(row), dtype=np.int64)
        back[row] = np.arange(len(row))
        return gather(np.concatenate(done_ids), np.concatenate([[0], np.cumsum(size)]), back)

    def _merge_matrix(self, pieces: list[bytes], lengths: np.ndarray):
        """Merges one matrix; yields ids, rows and sizes of the rows that a round finds done."""
        n, width = len(pieces), int(lengths.max())
        lengths = lengths.copy()
        ids = np.zeros((n, width), dtype=np.int32)
        filled = np.arange(width) < lengths[:, None]
        ids[filled] = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = np.full((n, width), NO_RANK, dtype=np.int32)  # of the pair that begins at a place
        begins = np.arange(width - 1) < lengths[:, None] - 1
        ranks[:, :-1][begins] = self.pairs.find(ids[:, :-1][begins], ids[:, 1:][begins])
        live = np.arange(n)
        while len(live):
            best = ranks.argmin(axis=1)
            each = np.arange(len(live))
            least = ranks[each, best]
            ended = least == NO_RANK
            if ended.any():
                sizes = lengths[ended]
                yield ids[ended][np.arange(ids.shape[1]) < sizes[:, None]].astype(np.uint32), live[ended], sizes
                go = np.flatnonzero(~ended)
                width = int(lengths[go].max()) if len(go) else 0
                live, lengths, best, least = live[go], lengths[go], best[go], least[go]
                ids, ranks = ids[go, :width], ranks[go, :width]
                each = np.arange(len(live))
                if not len(live):
                    break
            # close up: what stands behind a merged pair moves one place to the left
            if len(live) == 1:
                b = int(best[0])
                ids[0, b + 1 : -1] = ids[0, b + 2 :]
                ranks[0, b + 1 : -1] = ranks[0, b + 2 :]
            else:
                behind = np.arange(width - 1) > best[:, None]
                ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
                ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            ids[each, best] = least
            lengths -= 1
            after = best + 1 < lengths
            ranks[each, best] = NO_RANK
            if after.any():
                r, b = each[after], best[after]
                ranks[r, b] = self.pairs.find(ids[r, b], ids[r, b + 1])
            before = best > 0
            if before.any():
                r, b = each[before], best[before]
                ranks[r, b - 1] = self.pairs.find(ids[r, b - 1], ids[r, b])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids start."""
        texts = [t or "" for t in texts]
        if len(self.place) > KNOWN_PIECES or self.known_bytes > KNOWN_BYTES:
            self._forget()
        index, counts = self._cut(texts) if self.pattern.pattern == WORD_PATTERN else self._cut_by_regex(texts)
        ids, lengths = gather(self.token, self.start, index)
        piece_ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, piece_ends[np.concatenate([[0], np.cumsum(counts)])]

    def _places(self, pieces: list[str]) -> np.ndarray:
        """The places of different pieces in the store, after learning those that are new."""
        fresh = [p for p in pieces if p not in self.place]
        if fresh:
            self._learn(fresh)
        return np.fromiter(map(self.place.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def _cut_by_regex(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.pattern.findall(t) for t in texts]
        different = {p: i for i, p in enumerate(dict.fromkeys(p for pieces in cut for p in pieces))}
        place = self._places(list(different))
        index = np.fromiter((different[p] for pieces in cut for p in pieces), dtype=np.int64)
        return place[index], np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pieces, and the number in each text. Equal pieces are found by two
        independent hashes, so only different ones are cut out as strings."""
        joined = "".join(texts)
        ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
        if not joined:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        start = piece_starts(points, ends)
        end = np.append(start[1:], len(points))
        counts = np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))
        first, second = span_hashes(points, start, end)
        order = np.argsort(first)
        new = np.ones(len(order), dtype=bool)
        new[1:] = first[order][1:] != first[order][:-1]
        group = np.empty(len(order), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        head = order[new]
        if (second[head][group] != second).any():
            return self._cut_by_regex(texts)
        place = self._places([joined[a:b] for a, b in zip(start[head].tolist(), end[head].tolist(), strict=True)])
        return place[group], counts

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids one after the other, and the number of bytes of each id."""
        return gather(self.token_bytes, self.token_start, ids.astype(np.int64))


def gather(values: np.ndarray, start: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates values[start[i]:start[i + 1]] for every i of index; also gives their lengths."""
    lengths = start[index + 1] - start[index]
    total = int(lengths.sum())
    shift = np.repeat(start[index] - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(index) else start[:0], lengths)
    return values[shift + np.arange(total)], lengths


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(ranks, pattern: str) -> Codec:
    """The worker's codec for a broadcast rank list."""
    key = (ranks.id if hasattr(ranks, "id") else id(ranks), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks.value, pattern)
    return _codecs[key]


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def _out_schema(df: DataFrame, **added: str):
    kept = [F.col(f"`{c}`") for c in df.columns if c not in added]
    return df.select(*kept, *[F.lit(None).cast(kind).alias(name) for name, kind in added.items()]).schema


def _encoded(batches: Iterator[pa.RecordBatch], codec: Codec, text_col: str) -> Iterator[pa.RecordBatch]:
    """The batches, in parts, with `ids` and `n_tokens` behind the columns kept."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text_col))
        for at, part in chunks(texts):
            ids, bounds = codec.encode(part.to_pylist())
            rows = batch.slice(at, len(part))
            kept = [f.name for f in batch.schema if f.name not in ("ids", "n_tokens")]
            packed = _binary(ids.astype("<u4").view(np.uint8), bounds * 4)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(name) for name in kept), packed, pa.array(np.diff(bounds))], names=[*kept, "ids", "n_tokens"])
    codec._forget()  # workers live on; their known pieces need not


def _decoded(batches: Iterator[pa.RecordBatch], codec: Codec, ids_col: str) -> Iterator[pa.RecordBatch]:
    """The batches, in parts, with `decoded` behind the columns kept."""
    for batch in batches:
        packed = batch.column(batch.schema.get_field_index(ids_col))
        for at, part in chunks(packed):
            bounds = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
            body = part.buffers()[2]
            ids = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]].view("<u4") if body is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint32)
            data, lengths = codec.decode(ids)
            ends = np.concatenate([[0], np.cumsum(lengths)])[(bounds - bounds[0]) // 4]
            rows = batch.slice(at, len(part))
            kept = [f.name for f in batch.schema if f.name != "decoded"]
            yield pa.RecordBatch.from_arrays([*(rows.column(name) for name in kept), _binary(data, ends)], names=[*kept, "decoded"])


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Adds `ids`, the packed ids of the text, and `n_tokens`.

    The rank file (about a megabyte, its own size for any input) is read by the driver and
    broadcast. The job has no shuffle.
    """
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, _codec(ranks, pattern), text_col)

    return df.mapInArrow(run, _out_schema(df, ids="binary", n_tokens="long"))


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Adds `decoded`, the bytes that the packed ids stand for."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(batches, _codec(ranks, pattern), ids_col)

    return df.mapInArrow(run, _out_schema(df, decoded="binary"))


def encode_and_decode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Adds `ids` and `n_tokens` as `encode` does, then `decoded` from the packed ids as `decode` does."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        return _decoded(_encoded(batches, codec, text_col), codec, "ids")

    return df.mapInArrow(run, _out_schema(df, ids="binary", n_tokens="long", decoded="binary"))
