from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from pathproof.llm import packing
from pathproof.llm.tokens import byte_bpe, default_path
from tests.llm.conftest import texts_of

PATH = default_path("byte_bpe_50k.json")


def ids_of(text: str | None) -> np.ndarray:
    return np.array([*byte_bpe(PATH).library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")


def check_layout(pieces, most: int) -> list[int]:
    """Gapless offsets from 0; returns the sequences' lengths."""
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    sizes = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= most
        sizes.append(at)
    return sizes


@pytest.mark.parametrize("name", ["edge", "small"])
def test_every_id_lies_in_one_piece(request, name):
    docs = request.getfixturevalue(name)
    pieces = packing.pack_documents(docs, PATH, with_ids=True).collect()
    sizes = check_layout(pieces, 2048)
    assert sum(2048 - n for n in sizes if n & (n - 1)) == 0  # nothing is padded
    assert max(sum(p.sequence_id == s for p in pieces) for s in {p.sequence_id for p in pieces}) <= 256
    want = sorted(((i, tuple(ids_of(t))) for i, t in texts_of(docs)), key=str)
    # documents of one id are told apart by following each from its start
    parts = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p.ids, dtype="<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
        parts[p.doc_id, p.doc_tokens].append(p)
    assert sum(p.length for p in pieces) == sum(len(w[1]) for w in want)
    for doc_id, ids in want:
        found, at = parts[doc_id, len(ids)], 0
        while at < len(ids):
            piece = next(p for p in found if p.start == at and tuple(p.ids) == ids[at : at + p.length])
            found.remove(piece)
            at += piece.length
    assert not any(parts.values())


def test_query_has_the_digest_columns(small):
    out = packing.op3_packing(small, PATH)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_repeated_runs_give_equal_rows(small):
    runs = [sorted(map(tuple, packing.op3_packing(small, PATH).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_empty_table(nothing):
    assert packing.op3_packing(nothing, PATH).count() == 0


def test_conversations_keep_all_limits(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    limits = packing.Limits(tokens=1024, segments=3, loss_tokens=300)
    pieces = packing.pack_conversations(turns, PATH, limits).collect()
    sizes = check_layout(pieces, 1024)
    assert len(sizes) > 1
    by_turn = defaultdict(list)
    for r in turns.collect():
        by_turn[r.conv_id].append((r.turn, r.role, r.text))
    loss = {}
    for conv, parts in by_turn.items():
        loss[conv] = np.concatenate([np.full(len(ids_of(t)), role == "assistant") for _, role, t in sorted(parts)])
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    for parts in by_sequence.values():
        assert len(parts) <= 3
        assert sum(loss[p.conv_id][p.start : p.start + p.length].sum() for p in parts) <= 300
    assert sum(p.length for p in pieces) == sum(map(len, loss.values()))


def test_the_dot_product_chooses():
    packer = packing.Packer(packing.Limits(10, 4, 10))
    for key, n in enumerate([3, 6, 2, 4]):
        packer.pool.append(packing.Example(key, np.zeros(n, np.uint32), None, False))
    assert [e.key for e in packer._fill(10)] == [1, 3]  # the largest, then the one that fills the rest


def test_examples_that_may_not_be_cut():
    packer = packing.Packer(packing.Limits(10, 4, 10))
    with pytest.raises(ValueError):
        list(packer.add(packing.Example("a", np.zeros(11, np.uint32), None, False)))
    for k in range(7):
        assert not list(packer.add(packing.Example(k, np.zeros(4, np.uint32), None, False)))
    done = list(packer.finish())
    assert sorted(e.key for s in done for e in s) == list(range(7)) and all(len(s) <= 2 for s in done)
