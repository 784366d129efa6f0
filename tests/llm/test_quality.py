"""Quality classifier: held-out labels, one step against the plain formula, and edge cases."""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from pathproof.llm import quality
from pathproof.llm.queries import op13_quality

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    rows = op13_quality(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert sum(s >= 0.3 for s in good) >= 0.98 * len(good)
    assert sum(s < 0.3 for s in bad) >= 0.8 * len(bad)
    assert sum(a > b for a in good for b in bad) >= 0.98 * len(good) * len(bad)


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(docs, labels).weights, quality.fit(docs, turned).weights)


def test_a_step_is_the_plain_one():
    leader, z, n = quality.Leader(), {}, {}
    rng = np.random.default_rng(1)
    for _ in range(50):
        at, x, y = rng.choice(40, 6, replace=False), rng.random(6), int(rng.integers(2))
        w = {}
        for i in at.tolist():
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            w[i] = 0.0 if abs(zi) <= quality.L1 else (math.copysign(quality.L1, zi) - zi) / (
                (quality.BETA + math.sqrt(ni)) / quality.ALPHA + quality.L2
            )
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at.tolist(), x.tolist(), strict=True))))
        for i, v in zip(at.tolist(), x.tolist(), strict=True):
            g = (p - y) * v
            ni = n.get(i, 0.0)
            z[i] = z.get(i, 0.0) + g - (math.sqrt(ni + g * g) - math.sqrt(ni)) / quality.ALPHA * w[i]
            n[i] = ni + g * g
        leader.learn(at, x, y)
    assert all(math.isclose(leader.z[i], z[i], rel_tol=1e-9) and math.isclose(leader.n[i], n[i], rel_tol=1e-9) for i in z)


def test_score_is_the_dot_product_of_all_ngrams():
    known = quality._Known()
    text = "The the THE cat cat 12 !! é É".encode()
    at, x = quality.features(text, known)
    assert len(at) == len(x) and math.isclose(float(x @ x), 2.0)
    model = quality.Model(np.linspace(-1, 1, (1 << quality.BITS) + 1))
    want = model.weights[-1] + sum(model.weights[i] * v for i, v in zip(at.tolist(), x.tolist(), strict=True))
    assert math.isclose(model.score(text, known), 1 / (1 + math.exp(-want)), rel_tol=1e-12)
    shapes = [quality._shape(t) for t in (b"the", b"THE", b"The", b"I", b"12", b"!!", "é".encode(), "É".encode())]
    assert shapes == [0, 1, 2, 2, 3, 4, 0, 2]


def test_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 0, "x"), (7, 0, "x"), (9, 1, "x"), (12, 1, "x"), (-5, 1, "x"), (2, None, "x"), (None, 1, "x"), (3, 7, "x"), (99, 1, "x")],
        "doc_id long, quality int, text string",
    )
    model = quality.fit(edge, labels)
    rows = quality.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    bias = 1 / (1 + math.exp(-model.weights[-1]))
    texts = {(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()}
    blank = {i for i, t in texts if not (t or "").strip()}
    assert blank == {4, 5, 6, None}
    assert all(math.isclose(r.score, bias) for r in rows if r.doc_id in (4, 5, 6))
    assert quality.score(nothing, model).count() == 0
    for none in (quality.fit(nothing, labels), quality.fit(edge, labels.limit(0))):
        assert {r.score for r in quality.score(edge, none).collect()} == {0.5}


def test_parts_are_averaged(spark, small, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    monkeypatch.setattr(quality, "PART_ROWS", 20)
    model = quality.fit(small, labels)
    scores = {r.doc_id: r.score for r in quality.score(small, model).collect()}
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in scores}
    good, bad = ([scores[i] for i, y in known.items() if y == k] for k in (1, 0))
    assert sum(a > b for a in good for b in bad) >= 0.9 * len(good) * len(bad)
    bounded = quality.fit(small, labels, train_rows=5)
    assert np.count_nonzero(bounded.weights) < np.count_nonzero(model.weights)
