from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from pathproof.llm import simhash
from pathproof.llm.common import components
from tests.llm.conftest import texts_of


def fingerprint(text: str | None, k: int = 3) -> int:
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints: list[int], radius: int) -> list[int]:
    parent = list(range(len(prints)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("name", ["edge", "small"])
def test_groups_equal_all_pairs(request, name):
    docs = request.getfixturevalue(name)
    rows = texts_of(docs)
    prints = [fingerprint(t) for _, t in rows]
    least: dict[int, int | None] = {}
    for root, (i, _) in zip(reach := roots(prints, 3), rows, strict=True):
        least[root] = min((x for x in (least.get(root), i) if x is not None), default=None)
    want = [(i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, reach, strict=True)]
    got = [tuple(r) for r in simhash.op6_simhash(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("radius", [1, 3, 7, 11])
def test_links_equal_all_pairs(spark, radius):
    rnd = random.Random(radius)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        center = rnd.getrandbits(64)
        prints.add(center)
        for _ in range(25):
            changed = center
            for _ in range(rnd.randint(1, radius + 2)):
                changed ^= 1 << rnd.randrange(64)
            prints.add(changed)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    got = {tuple(r) for r in simhash.links(df, radius).collect()}
    want = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    }
    assert got == want and want


def test_long_texts_are_counted_in_slices(monkeypatch):
    text = " ".join(str(k % 97) for k in range(1000))
    whole = simhash.simhash(text)
    monkeypatch.setattr(simhash, "_SLICE", 7)
    assert simhash.simhash(text) == whole == fingerprint(text)


def test_one_document_of_each_group_stays(edge, small):
    kept = simhash.one_of_each_group(edge)
    assert kept.columns == edge.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids.count(1) == 1 and 2 not in ids  # copies
    assert sum(i in (4, 5, 6) for i in ids) == 1 and 4 in ids  # no words: all alike
    assert ids.count(9) == 2  # the repeated row goes, the other text of that id stays
    rows = texts_of(small)
    for i, k in [(min(a, b), max(a, b)) for a, x in rows for b, y in rows if a < b and x == y]:
        assert k not in {r["doc_id"] for r in simhash.one_of_each_group(small).select("doc_id").collect()}, i


def test_near_copies_go_and_texts_that_share_a_refrain_stay(spark):
    """Half of the text being one repeated word makes equal fingerprints, but no near copies."""
    rnd = random.Random(9)
    words = [f"w{k}" for k in range(400)]

    def text(n: int) -> list[str]:
        return [rnd.choice(words) for _ in range(n)]

    base = text(300)
    near = list(base)
    for at in (40, 150, 260):
        near[at] = "other"
    half = base[:150] + text(150)
    refrains = [" ".join(["la"] * 200 + text(60)) for _ in range(2)]
    docs = [" ".join(x) for x in (base, near, half)] + refrains
    assert simhash.simhash(refrains[0]) == simhash.simhash(refrains[1])
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each_group(df).collect()) == [0, 2, 3, 4]


def test_near_copies_equal_all_pairs_without_a_bound_on_bits(spark):
    """Texts of 5 to 120 words, edited; many of the pairs differ in more than 7 bits of the fingerprint."""
    rnd = random.Random(12)
    words = [f"w{k}" for k in range(300)]
    docs = []
    for n in [5, 8, 14, 20, 30, 45, 60, 120] * 6:
        base = [rnd.choice(words) for _ in range(n)]
        for k in range(4):
            other = list(base)
            for _ in range(k * n // 60 + (k > 0)):
                other[rnd.choice([0, 1, len(other) - 1, rnd.randrange(len(other))])] = rnd.choice(words)
            docs.append(" ".join(other + ["w1"] * rnd.randint(0, 1)))
    rnd.shuffle(docs)

    def runs(text: str) -> set[tuple]:
        split = text.split()
        return {tuple(split[i : i + 5]) for i in range(max(1, len(split) - 4))}

    sets, prints = [runs(t) for t in docs], [fingerprint(t) for t in docs]
    head = list(range(len(docs)))

    def find(x: int) -> int:
        while head[x] != x:
            x = head[x]
        return x

    bits = []
    for i in range(len(docs)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                bits.append((prints[i] ^ prints[j]).bit_count())
                x, y = sorted((find(i), find(j)))
                head[y] = x
    assert sum(b > 7 for b in bits) > 10 and max(bits) > 11
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.one_of_each_group(df).collect())
    assert kept == sorted({find(i) for i in range(len(docs))})


def test_order_of_common_runs_does_not_change_near_copies(spark, small, monkeypatch):
    want = sorted(map(str, simhash.one_of_each_group(small).select("doc_id", "text").collect()))
    monkeypatch.setattr(simhash, "COMMON", 1)
    monkeypatch.setattr(simhash, "FIRST_RUNS", 1)
    assert sorted(map(str, simhash.one_of_each_group(small).select("doc_id", "text").collect())) == want


def test_components_of_long_paths(spark):
    rnd = random.Random(2)
    nodes = list(range(300))
    rnd.shuffle(nodes)
    edges = list(zip(nodes, nodes[1:], strict=False)) + [(1000, 1001), (1001, 1002), (5000, 5000)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: 0 for n in nodes} | {1000: 1000, 1001: 1000, 1002: 1000}


def test_empty_table(nothing):
    assert simhash.op6_simhash(nothing).count() == 0
    assert simhash.one_of_each_group(nothing).count() == 0
