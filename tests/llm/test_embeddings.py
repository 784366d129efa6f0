from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pathproof.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, node string, strip int, linked int"


def expected(rows: list[tuple], threshold: float = 0.9) -> list[tuple]:
    vectors = []
    for _, v in rows:
        usable = bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        vectors.append(np.array(v, dtype=np.float32).astype(float) if usable else None)
    n = len(rows)
    parent, degree = list(range(n)), [0] * n

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b):
                if np.array_equal(a, b) or a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                    degree[i] += 1
                    degree[j] += 1
                    parent[find(i)] = find(j)
    least: dict = {}
    for i, (vec_id, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), vec_id) if x is not None), default=None)
    return sorted(
        ((v, degree[i], least[find(i)], v is not None and v == least[find(i)]) for i, (v, _) in enumerate(rows)), key=str
    )


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 1, 2) for i, v in rows], SCHEMA)


def answers(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=str)


def test_edge_cases(spark):
    rows = [
        (1, [1.0, 0.0, 0.0]),
        (2, [1.0, 0.0, 0.0]),
        (3, [2.0, 0.0, 0.0]),
        (4, [0.95, 0.3, 0.0]),
        (5, None),
        (6, []),
        (7, [0.0, 0.0, 0.0]),
        (8, [1.0, float("nan"), 0.0]),
        (9, [1.0, float("inf"), 0.0]),
        (10, [1.0, None, 0.0]),
        (11, [1.0, 0.0]),  # another length
        (12, [-1.0, 0.0, 0.0]),
        (None, [1.0, 0.01, 0.0]),
        (None, [0.0, 0.0, -3.0]),
        (13, [1.0, 0.0, 0.0]),
        (13, [1.0, 0.0, 0.0]),  # a repeated row
        (14, [-0.0, 1e-30, 1.0]),
        (15, [0.0, 1e-30, 1.0]),
        (16, [1e30, 1e29, 0.0]),
    ]
    assert answers(embeddings.op10_embeddings(table(spark, rows))) == expected(rows)


@pytest.mark.parametrize("strip", [40, 4096])
def test_clusters_equal_all_pairs(spark, monkeypatch, strip):
    monkeypatch.setattr(embeddings, "STRIP", strip)
    monkeypatch.setattr(embeddings, "TILE", 16)
    rnd = np.random.default_rng(1)
    rows = []
    for _ in range(15):
        center = rnd.normal(size=24)
        for _ in range(10):
            rows.append((len(rows), (center + rnd.normal(size=24) * rnd.uniform(0, 0.6)).astype(np.float32).tolist()))
    rows += [(len(rows) + k, rows[k][1]) for k in range(12)]  # copies
    got = answers(embeddings.op10_embeddings(table(spark, rows)))
    assert got == expected(rows) and sum(r[1] for r in got) > 200


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([3, 64, 300]), st.floats(0.1, 0.99))
def test_error_bounds_hold(seed, dims, threshold):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(20, dims)) * np.exp(rnd.normal(size=(20, dims)) * 2)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = embeddings.quantise(unit)
    approx = embeddings.tile_products(q, q) * np.outer(s, s)
    bound = (1 + e[:, None]) * e[None, :] + e[:, None]
    assert (np.abs(approx - unit @ unit.T) <= bound + embeddings.SLACK).all()
    pairs = {(int(a), int(b)) for p in embeddings.linked_pairs(x, x, threshold) for a, b in zip(*p, strict=True)}
    sure = {(int(a), int(b)) for a, b in zip(*np.nonzero(unit @ unit.T >= threshold + 1e-9), strict=True)}
    maybe = {(int(a), int(b)) for a, b in zip(*np.nonzero(unit @ unit.T >= threshold - 1e-9), strict=True)}
    assert sure <= pairs <= maybe


def test_many_dimensions_stay_exact():
    rnd = np.random.default_rng(3)
    q = rnd.choice([-127, 127], size=(3, 2 * embeddings.EXACT_DIMS + 5)).astype(np.int8)
    assert (embeddings.tile_products(q, q) == q.astype(np.int64) @ q.astype(np.int64).T).all()


def test_empty_table(spark):
    assert embeddings.op10_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0
