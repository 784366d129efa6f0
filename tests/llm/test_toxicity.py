from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pathproof.llm import toxicity

SF = "/root/testdata/sf0.1"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-0.5, 1.0, 2.5, -2.0, 0.25]), max_size=14))
def test_segments_equal_brute_force(weights):
    """The best segment first, then what is left and right of it, again: these are the maximal ones."""

    def best(low: int, high: int) -> list[tuple[int, int]]:
        found = None
        for i in range(low, high):
            for j in range(i, high):
                total = sum(weights[i : j + 1])
                if total > 1e-12 and (found is None or total > found[0] + 1e-12 or (abs(total - found[0]) <= 1e-12 and j - i < found[2] - found[1])):
                    found = (total, i, j)
        if found is None:
            return []
        return best(low, found[1]) + [(found[1], found[2])] + best(found[2] + 1, high)

    hits = [(i, w) for i, w in enumerate(weights) if w != -0.5]
    got = toxicity.maximal_segments(hits, drift=-0.5)
    scores = sorted(round(s.score, 6) for s in got)
    assert scores == sorted(round(sum(weights[i : j + 1]), 6) for i, j in best(0, len(weights)))
    assert all(math.isclose(s.score, sum(weights[s.first : s.last + 1]), abs_tol=1e-9) for s in got)


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.op4_toxicity(docs, labels).toPandas(), labels.toPandas(), docs.count()


def test_held_out_accuracy(scored):
    found, labels, n = scored
    assert len(found) == n and found["score"].between(0, 1).all()
    assert (found["predicted"] == (found["score"] >= 0.7)).all()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found["doc_id"]]).all()
    held = found[found["held_out"]].merge(labels, on="doc_id")
    toxic, clean = held[held["toxic"] == 1], held[held["toxic"] == 0]
    ranks = held["score"].rank()
    area = (ranks[held["toxic"] == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / len(toxic) / len(clean)
    assert area > 0.95 and toxic["predicted"].mean() > 0.9 and clean["predicted"].mean() < 0.02


def test_labels_of_held_out_rows_have_no_influence(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) as toxic"
    )
    runs = [toxicity.op4_toxicity(small, x).select("doc_id", "score").orderBy("doc_id").collect() for x in (labels, turned)]
    assert runs[0] == runs[1]


def test_edge_cases(spark, edge):
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (7, 1), (9, None), (None, 1), (500, 1), (11, 7), (3, 0), (12, 0)], "doc_id long, toxic int"
    )
    out = toxicity.op4_toxicity(edge, labels)
    found = out.collect()
    assert len(found) == edge.count() and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found if r.doc_id in (4, 5, 6)} == {0.0}
    kept = toxicity.clean_documents(edge, toxicity.fit(edge, labels))
    assert kept.columns == edge.columns and kept.where("doc_id in (4, 5, 6)").count() == 3


@pytest.mark.parametrize("labelled", [[], [(1, 0)], [(2, 1)]])
def test_one_sided_labels(spark, edge, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.op4_toxicity(edge, labels).collect()} == {0}


def test_empty_table(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.op4_toxicity(nothing, labels).count() == 0


def test_extreme_value_law_is_monotone():
    model = toxicity.Model({}, frozenset(), scale=1.2, k=0.01, curve=(-3.0, 2.0))
    p = [model.p_value([s], 300) for s in (0.5, 2.0, 5.0, 9.0)]
    assert p == sorted(p, reverse=True) and model.p_value([9.0, 8.0], 300) < p[-1]
    assert np.all(np.diff([model.probability(x) for x in p]) > 0)
