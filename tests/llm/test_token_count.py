from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pathproof.llm import tokencount
from pathproof.llm.tokens import byte_bpe, default_path
from tests.llm.conftest import texts_of

PATH = default_path("byte_bpe_50k.json")
SIGNS = st.sampled_from([*"ab c\n\t'sé12.,  ", "the ", " and ", "  ", "<|endoftext|>"])
TEXT = st.lists(SIGNS, max_size=60).map("".join)


def count(text: str) -> int:
    return len(byte_bpe(PATH).library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-3, 130), st.integers(0, 40), st.lists(SIGNS, max_size=6).map("".join)), max_size=6))
def test_edited_counts_equal_full_counts(text, edits):
    old, tokencount.LEAF = tokencount.LEAF, 8
    try:
        tree = tokencount.TokenTree.build(text, byte_bpe(PATH))
        for start, deleted, inserted in edits:
            low = min(max(start, 0), len(text))
            text = text[:low] + inserted + text[low + deleted :]
            tree.edit(start, deleted, inserted)
            assert tree.text == text and tree.tokens() == count(text) and tree.sums[1, 0] == len(text)
    finally:
        tokencount.LEAF = old


def edited(text: str | None) -> str:
    old = text = text or ""
    n = len(old)
    text = text[: n // 3] + old[:40] + text[n // 3 :]
    text = text[: n // 2] + " amended text" + text[n // 2 + 10 :]
    low = max(0, n - 30)
    return text[:low] + text[low + 25 :]


@pytest.mark.parametrize("name", ["edge", "small"])
def test_query_equals_full_counts(request, name):
    docs = request.getfixturevalue(name)
    got = sorted(
        ((r.doc_id, r.n_tokens, r.edited_tokens, r.edited_chars) for r in tokencount.op2_tokencount(docs, PATH).collect()),
        key=str,
    )
    want = [(i, count(t or ""), count(edited(t)), len(edited(t))) for i, t in texts_of(docs)]
    assert got == sorted(want, key=str)


def test_only_touched_leaves_are_encoded():
    text = "some words of a long text " * 4000
    tree = tokencount.TokenTree.build(text, byte_bpe(PATH))
    tree.edit(50_000, 3, "new")
    assert 0 < tree.encoded < 4 * tokencount.LEAF


def test_edits_from_a_table(spark, edge):
    state = tokencount.build(edge, PATH)
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, "One"), (1, 1, 0, 0, "A "), (99, 1, 0, 0, "x"), (None, 1, 0, 0, "x"), (5, 1, None, None, None)],
        "doc_id long, seq int, start int, deleted int, inserted string",
    )
    out = {r.doc_id: r for r in tokencount.update(tokencount.with_edits(state, edits), PATH).collect()}
    text = {i: t for i, t in texts_of(edge)}[1]
    assert out[1].text == "One" + ("A " + text)[3:] and out[1].n_tokens == count(out[1].text)
    assert out[5].text == "" and out[4].text is None and out[4].n_tokens == 0 and out[3].encoded_chars == 0


def test_empty_table(nothing):
    assert tokencount.op2_tokencount(nothing, PATH).count() == 0
