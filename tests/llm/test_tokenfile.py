from __future__ import annotations

import hashlib
import io
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from pathproof.llm import tokenfile, tokens
from tests.llm.conftest import texts_of

PATH = tokens.default_path("word_bpe_49k.json")
BYTES = tokens.default_path("byte_bpe_50k.json")
SIGNS = "ab'st RE\n\t  é ß1²½.,!-…😀ＡΣσς漢\x1c\x85\xa0İIǅ́"


@settings(max_examples=300, deadline=None)
@given(st.text(SIGNS, max_size=30) | st.text(max_size=20).filter(lambda t: t.isprintable()))
def test_ids_are_the_librarys(text):
    word, byte = tokens.word_bpe(PATH), tokens.byte_bpe(BYTES)
    for special in ("", "<|endoftext|>"):
        t = text + special + text
        assert np.frombuffer(word.encode(t), word.dtype).tolist() == word.library.encode(t, add_special_tokens=False).ids
        assert byte.ids(t).tolist() == byte.library.encode(t, add_special_tokens=False).ids


def test_ids_of_a_corpus(small):
    word, byte = tokens.word_bpe(PATH), tokens.byte_bpe(BYTES)
    for _, t in texts_of(small):
        assert np.frombuffer(word.encode(t), word.dtype).tolist() == word.library.encode(t, add_special_tokens=False).ids
        assert byte.ids(t).tolist() == byte.library.encode(t, add_special_tokens=False).ids


def test_full_caches_change_nothing(small, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    word = tokens.WordBpe(PATH)
    t = texts_of(small)[0][1]
    assert np.frombuffer(word.encode(t), word.dtype).tolist() == word.library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["edge", "small"])
def test_round_trip(request, name):
    docs = request.getfixturevalue(name)
    library = tokens.word_bpe(PATH).library
    rows = sorted(
        texts_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
    )
    want, at = [], 0
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = sorted(map(tuple, tokenfile.op8_tokenfile(docs, PATH).collect()), key=lambda r: r[1])
    assert got == want


def write_file(path, documents) -> str:
    uri = f"file://{path}/a.ids.zst"
    writer = tokenfile.Writer(uri, np.dtype("<u2"))
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, dtype="<u2").tobytes())
    writer.close()
    return uri


def test_only_requested_frames_are_read(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "FRAME_BYTES", 200)
    documents = [(k, list(range(k, k + 60))) for k in range(50)] + [(None, [7]), (99, [])]
    reader = tokenfile.Reader(write_file(tmp_path, documents))
    read = []
    inner = reader.frame
    reader.frame = lambda number: read.append(number) or inner(number)
    found = list(reader.documents([17, None, 99]))
    assert [(i, ids.tolist()) for i, _, ids in found] == [(17, list(range(17, 77))), (None, [7]), (99, [])]
    assert [start for _, start, _ in found] == [17 * 60, 3000, 3001] and len(read) == 2 and len(reader.table) > 40


def test_any_zstandard_reader_can_read_it(tmp_path):
    uri = write_file(tmp_path, [(1, [1, 2, 3]), (2, [4])])
    data = open(uri.removeprefix("file://"), "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(whole[:8], "<u2").tolist() == [1, 2, 3, 4]


def test_damage_is_found(tmp_path):
    uri = write_file(tmp_path, [(1, list(range(2000)))])
    path = uri.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    for at, error in ((20, "frame 0"), (len(data) - 1, "seek table")):
        broken = bytearray(data)
        broken[at] ^= 0xFF
        open(path, "wb").write(broken)
        with pytest.raises(tokenfile.BadFrame, match=error):
            list(tokenfile.Reader(uri).documents())
    open(path, "wb").write(data[:-5])
    with pytest.raises(tokenfile.BadFrame):
        tokenfile.Reader(uri)


def test_empty_table(nothing):
    assert tokenfile.op8_tokenfile(nothing, PATH).count() == 0
