"""Phrase collocations against plain counting of all runs of words."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pathproof.llm import phrases
from pathproof.llm.queries import ORACLES, op12_phrases

SF = "/root/testdata/sf0.001"
_LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text: str | None) -> list[list[str]]:
    split = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER))
    return [re.findall(r"[^\x20\x09]+", p) for p in split]


def expected(docs: list[tuple], least: int = 10, share: int = 50, top: int = 2000) -> list[tuple]:
    f: dict = defaultdict(Counter)
    for lang, text in docs:
        for words in pieces(text):
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        frequent = [p for p, c in counts.items() if len(p) >= 2 and c >= least]
        found = []
        for p in frequent:
            a = counts[p]
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * counts[q] >= share * a for q in frequent):
                continue
            cuts = [(1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n, -score))
    return sorted(out)


def answer(docs, **options) -> list[tuple]:
    return sorted(map(tuple, phrases.collocations(docs, **options).collect()))


def pairs(df) -> list[tuple]:
    return [tuple(r) for r in df.select("lang", "text").collect()]


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(map(tuple, op12_phrases(spark, SF).collect())) == sorted(con.execute(ORACLES["op12_phrases"]).fetchall())


@pytest.mark.parametrize("options", [{"top": 5}, {"least": 3, "share": 80}, {"shard_words": 500, "marks": 64}])
def test_equals_plain_counting(small, options):
    """A few words a shard and a bitmap that marks nearly everything change nothing."""
    rules = {k: v for k, v in options.items() if k not in ("shard_words", "marks")}
    want = expected(pairs(small), **rules)
    assert want and answer(small.repartition(7), **options) == want


def test_edge_cases(spark, edge, nothing):
    want = expected(pairs(edge), least=2)
    assert want and answer(edge, least=2) == want
    assert answer(nothing) == []
    assert answer(spark.createDataFrame([(None, None), ("en", ""), ("en", " .;")], "lang string, text string")) == []


def test_hot_phrase_and_ties(spark):
    docs = [("en", "a b c")] * 300 + [(None, "x y. x y, X Y\tz")] * 5 + [("en", "b c d; e f")] * 12
    df = spark.createDataFrame(docs, "lang string, text string").repartition(6)
    assert answer(df) == expected(docs)


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000_000, 5_000_000_000_000, 3_000_000_000_007)], "a long, l long, r long")
    a, x, y = 3_000_000_000_000, 5_000_000_000_000, 3_000_000_000_007
    assert big.select(phrases._score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (x * y)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 5), max_size=12), max_size=6))
def test_intervals_hold_the_occurrences(texts):
    a = np.array([0] + [s for t in texts for s in [*t, 0]], dtype=np.uint32)
    index = phrases.FmIndex.of(a)
    counts = Counter(tuple(t[i : i + k]) for t in texts for k in (1, 2, 3) for i in range(len(t) - k + 1))
    rows = sorted(range(len(a)), key=lambda i: (*a[i : i + 3], *[0] * 3)[:3])
    back = sorted(range(len(a)), key=lambda i: (*a[::-1][i : i + 3], *[0] * 3)[:3])

    def check(p: phrases.Phrases) -> dict:
        found = {}
        for words, row, reverse, n in zip(p.words.tolist(), p.rows, p.back, p.counts, strict=True):
            k = len(words)
            assert all(a[i : i + k].tolist() == words for i in rows[row : row + n])
            assert all(a[::-1][i : i + k].tolist() == words[::-1] for i in back[reverse : reverse + n])
            found[tuple(words)] = int(n)
        return found

    singles = index.singles()
    two = index.to_left(singles, index.left(singles))
    also = index.to_right(singles, index.right(singles))
    three = [index.to_right(two, index.right(two)), index.to_left(two, index.left(two))]
    for k, p in ((1, singles), (2, two), (2, also), (3, three[0]), (3, three[1])):
        want = {w: n for w, n in counts.items() if len(w) == k}
        assert {w: n for w, n in check(p).items() if n} == want


def test_order_of_many_symbols():
    a = np.random.default_rng(0).integers(0, 5, 200).astype(np.uint32)
    assert np.array_equal(a[phrases._order(a, 5)], a[phrases._order(a, 1 << 22)])
    assert phrases._unpacked(phrases._packed(np.array([0, 1, 70_000, 2**32 - 1]))).tolist() == [0, 1, 70_000, 2**32 - 1]
