from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pathproof.llm import pieces
from pathproof.llm.tokens import default_path
from tests.llm.conftest import texts_of

PATH = default_path("piece_bpe_32k.model")
SIGNS = st.sampled_from([*"ab c\n\té漢😀▁  '.,1\x00", "the", "ing", "  ", "    ", "<s>", "<0x41>"])
TEXT = st.lists(SIGNS, max_size=40).map("".join)


def library():
    return pieces.codec(PATH).model.library


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.integers(1, 9), min_size=1, max_size=8))
def test_streams_equal_the_library(text, steps):
    codec = pieces.codec(PATH)
    want = library().encode(text)
    assert codec.encode(text).tolist() == want
    assert codec.decode(want) == library().decode(want)
    search, out, at, k = pieces.Search(codec.model), [], 0, 0
    signs = pieces.SPACE + text.replace(" ", pieces.SPACE) if text else ""
    while at < len(signs):
        out += search.feed(signs[at : at + steps[k % len(steps)]])
        at += steps[k % len(steps)]
        k += 1
    assert out + search.finish() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=30))
def test_any_ids_decode_as_the_library_does(ids):
    ids = [i for i in ids if i != 0]
    assert pieces.codec(PATH).decode(ids) == library().decode(ids)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, "the" * 1500, " " * 300, "x" + " " * 100 + "y", "漢字" * 900])
def test_windows_stay_bounded(text):
    search = pieces.Search(pieces.codec(PATH).model)
    out, widest = [], 0
    signs = pieces.SPACE + text.replace(" ", pieces.SPACE)
    for at in range(0, len(signs), 64):
        out += search.feed(signs[at : at + 64])
        widest = max(widest, len(search.window))
    assert out + search.finish() == library().encode(text)
    assert widest <= 256


@pytest.mark.parametrize("name", ["edge", "small"])
def test_query(request, name):
    docs = request.getfixturevalue(name)
    want = []
    for i, t in texts_of(docs):
        ids = library().encode(t or "")
        want.append((i, len(ids), zlib.crc32(np.array(ids, dtype="<i4").tobytes()), library().decode(ids) == (t or "")))
    got = [tuple(r) for r in pieces.op9_pieces(docs, PATH).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_null_ids_decode_to_null(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [1318])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in pieces.decode(df, PATH).collect()}
    assert got == {1: None, 2: "", 3: library().decode([1318])}


def test_empty_table(nothing):
    assert pieces.op9_pieces(nothing, PATH).count() == 0
