"""Words, windows, and byte-level BPE against the reference library of the format."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from staffcast.llm import bpe, words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIST = bpe.read_ranks(RANKS)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(LIST), special_tokens={})
CODEC = bpe.Codec(LIST, public_tokenizers.PATTERN)
TEXTS = [
    None, "", " ", "a", "a" * 700, "Don't we'll 's I'd  x'ves ''s ' s", "tabs\t\tand\n\n lines \r\n ", "été  naïve Straße",
    "1234 5678,9!!! ###", "日本語 текст", "     mixed\u0085 spaces", "<|endoftext|>", "a\x1c\x1d b", "é" * 300,
]


def test_words_are_cut_as_the_pattern_says():
    texts = [t for t in TEXTS if t is not None] + ["\x0b\x0cx\x0dy"]
    got = words.cut(pa.array(texts))
    for i, text in enumerate(texts):
        found = [got.data[a:b].tobytes().decode() for a, b in zip(got.start[got.first[i]:got.first[i + 1]], got.end[got.first[i]:got.first[i + 1]])]
        assert found == re.findall(words.WORD, text)


def test_equal_words_have_equal_hashes_wherever_they_stand():
    got = words.cut(pa.array(["abc x abc", None, "ABC abc ab c"]))
    h, low = words.hashes(got), words.hashes(got, lower=True)
    assert h[0] == h[2] == h[4] and h[3] != h[0] and low[3] == low[0] and len(set(h.tolist())) == 5
    values, at = words.windows(got, h, 2)
    assert at.tolist() == [0, 1, 3, 4, 5]  # no window crosses a text


def test_chunks_cover_all_rows():
    texts = pa.array(["x" * k for k in (5, 0, 50, 3, 3)] + [None])
    assert [(a, len(t)) for a, t in words.chunks(texts, 8)] == [(0, 2), (2, 1), (3, 3)]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(text):
    ids, bounds = CODEC.encode([text])
    assert ids.tolist() == REFERENCE.encode_ordinary(text or "") and bounds.tolist() == [0, len(ids)]
    assert CODEC.decode(ids)[0].tobytes() == (text or "").encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'stlverd 1!.\n\té 日"), max_size=40), min_size=1, max_size=4))
def test_same_ids_for_any_texts(texts):
    ids, bounds = CODEC.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == REFERENCE.encode_ordinary(text)


def test_other_patterns_use_the_regex():
    codec = bpe.Codec(LIST, r"\s+|\S+")
    reference = tiktoken.Encoding("other", pat_str=r"\s+|\S+", mergeable_ranks=dict(LIST), special_tokens={})
    assert codec.encode(["one two,three  four"])[0].tolist() == reference.encode_ordinary("one two,three  four")


def test_columns_round_trip(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, ids string")
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "ids", "n_tokens"]
    for r in bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect():
        want = REFERENCE.encode_ordinary(r.text or "")
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_a_worker_that_forgets_gives_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 3)
    codec = bpe.Codec(LIST, public_tokenizers.PATTERN)
    for text in ("one two three four five", "six one seven", "one"):
        assert codec.encode([text])[0].tolist() == REFERENCE.encode_ordinary(text)
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256(codec.encode([""])[0].tobytes()).hexdigest()


def test_long_pieces_are_forgotten_by_their_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 1000, raising=False)
    codec, held = bpe.Codec(LIST, public_tokenizers.PATTERN), []
    for letter in "abcdefgh":
        text = letter * 300 + "z" * 300
        assert codec.encode([text])[0].tolist() == REFERENCE.encode_ordinary(text)
        held.append(sum(map(len, codec.place)))
    assert max(held) <= 1000 + 600 and held[-1] < sum(600 for _ in held)


def test_both_steps_in_one_give_the_same(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS * 2)], "doc_id long, text string, decoded string")
    two = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    one = bpe.encode_and_decode(docs, RANKS, public_tokenizers.PATTERN)
    assert one.columns == two.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert bpe.encode_and_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
