"""Ranked search against a plain scorer over all documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from pathproof.llm import search
from pathproof.llm.queries import ORACLES, op11_search

SF = "/root/testdata/sf0.001"
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").translate(_LOWER))


def expected(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, words = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked: dict = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, ts in asked.items():
        scores = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in ts & c.keys()
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def answer(docs, items, k: int = 10, **options) -> list[tuple]:
    return sorted(map(tuple, search.ranked(docs, items, k, **options).collect()), key=str)


def pairs(df, *names: str) -> list[tuple]:
    return [tuple(r) for r in df.select(*names).collect()]


@pytest.mark.parametrize("k", [1, 10])
def test_equals_all_scores(spark, small, k):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert answer(small, items, k) == expected(pairs(small, "doc_id", "text"), pairs(items, "item_id", "text"), k)


def test_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = con.execute(ORACLES["op11_search"]).fetchall()
    assert sorted(map(tuple, op11_search(spark, SF).collect())) == sorted(want)


ITEMS = [
    (1, "the quick brown FOX, lazy dog"),
    (2, None),
    (3, "!!! ???"),
    (4, "no such word: zzzzz"),
    (5, "word word word end"),
    (6, "ΑΣ İ 漢字 é specials"),
    (7, "the line of"),
    (7, "tiere WALD Σ über"),  # a second row of one item
    (7, "the line of"),
    (None, "another text under a null item"),
]


def test_edge_cases(spark, edge):
    items = spark.createDataFrame([(i, t, "clash") for i, t in ITEMS], "item_id long, text string, rank string")
    assert answer(edge, items) == expected(pairs(edge, "doc_id", "text"), ITEMS)


def test_empty_tables(spark, edge, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert answer(nothing, items) == [] and answer(edge, items.limit(0)) == []


def test_many_equal_documents_of_one_stratum(spark, monkeypatch):
    """Ties across the rows of a stratum; rows and sums are cut small, and blocks hold few terms."""
    monkeypatch.setattr(search, "_SUMMED", 20)
    monkeypatch.setattr(search, "_ORDERED", 3)
    monkeypatch.setattr(search, "BLOCK_TERMS", 10)
    docs = [(k * 37 % 200, "same text here" if k % 3 else f"same text {'here ' * (k % 5)}") for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame(ITEMS + [(9, "same here text"), (10, "here")], "item_id long, text string")
    assert answer(df, items, stratum_docs=7) == expected(docs, ITEMS + [(9, "same here text"), (10, "here")])


def test_strata_hold_all_postings_and_bounds_hold(spark, small):
    vocabulary = {t: i for i, t in enumerate([b"the", b"of", b"la", b"und"])}
    index = search.build(small, vocabulary)
    seen: Counter = Counter()
    ms = []
    for r in index.strata.collect():
        ms.append(r.m)
        ends = [*r.starts[1:], len(r.members)]
        for t, tf, a, b in zip(r.terms, r.tfs, r.starts, ends, strict=True):
            for member in r.members[a:b]:
                seen[r.docs[member], t] += tf
    want = Counter()
    for i, text in pairs(small, "doc_id", "text"):
        for t, tf in Counter(terms(text)).items():
            if t.encode() in vocabulary:
                want[i, vocabulary[t.encode()]] += tf
    assert seen == want
    assert len(set(ms)) == len(ms)
    assert np.array_equal(np.sort(search.impacts(np.arange(1, 50), 30)), search.impacts(np.arange(1, 50), 30))


def test_terms_split_at_ascii_only():
    want = ["a", "b", "c9", "É\u00a0é\x85x\u2028y", "z"]
    assert search.terms_of("A-b_c9 É\u00a0é\x85x\u2028y Z".encode()) == [x.encode() for x in want]
    assert search.terms_of(None) == []
