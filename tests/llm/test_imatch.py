from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from pathproof.llm import imatch
from pathproof.llm.common import text_key
from tests.llm.conftest import texts_of


def ordered(docs) -> list[tuple]:
    rows = [(i, t or "") for i, t in texts_of(docs)]
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))


def with_edits(docs) -> list[tuple]:
    rows = ordered(docs)
    out = []
    for k, (i, t) in enumerate(rows):
        following, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", ["edge", "small"])
@pytest.mark.parametrize("rows_per_bucket", [3, 512])
def test_edited_texts(request, monkeypatch, name, rows_per_bucket):
    monkeypatch.setattr(imatch, "BUCKET_ROWS", rows_per_bucket)
    docs = request.getfixturevalue(name)
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in imatch.op5_imatch(docs).collect()]
    assert sorted(got, key=str) == with_edits(docs)


def test_buckets_do_not_change_the_rows(small, monkeypatch):
    def found():
        return sorted(map(tuple, imatch.op5_imatch(small).collect()))

    whole = found()
    monkeypatch.setattr(imatch, "BUCKET_ROWS", 7)
    assert found() == whole


def test_many_bounds():
    bounds = sorted({(k * 37) % 1009 for k in range(300)})
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.range(-3, 1015).select(F.col("id").alias("ident"))
    got = df.select("ident", imatch._below(bounds, F.col("ident")).alias("n"), imatch._is_bound(bounds).alias("b"))
    for r in got.collect():
        assert r.n == sum(b < r.ident for b in bounds) and r.b == (r.ident in bounds)


def test_equal_texts_have_equal_fingerprints(edge):
    out = imatch.op5_imatch(edge).where("doc_id in (1, 2)").collect()
    assert len({r.fingerprint for r in out}) == 1
    assert next(r.near_next for r in out if r.doc_id == 2) == 1.0


def test_fingerprints_by_brute_force(small):
    """The subsets of each level, from the sorted terms that lie within the band."""
    docs = small.withColumn("key", text_key(F.col("text")))
    per_doc = {r.doc_id: r.terms for r in docs.select("doc_id", imatch.terms(F.col("text")).alias("terms")).collect()}
    n = len(per_doc)
    counts: dict[int, int] = {}
    for terms in per_doc.values():
        for t in set(terms):
            counts[t] = counts.get(t, 0) + 1
    low, high = (max(2.0, s * n) for s in imatch.SHARES)
    band = {t for t, c in counts.items() if low <= c <= high}
    got = {r.doc_id: r.fingerprint.split(".") for r in imatch.op5_imatch(small).collect()}
    for doc_id, terms in per_doc.items():
        chosen = {t for t in terms if t in band}
        if len(chosen) < imatch.FEW_TERMS:
            chosen |= set(terms[: imatch.FIRST_TERMS])
        first, hashes = int(got[doc_id][0]), got[doc_id][1:]
        size = len(chosen)
        assert first == max(0, (max(1, size) // imatch.PER_LEVEL).bit_length() - 1)
        for k in range(imatch.LEVELS):
            level = first + k
            mask = imatch.PER_LEVEL * 2**level - 1
            for j in range(imatch.PER_LEVEL):
                held = any(((t % 2**64) >> (20 * (level % 3))) & mask == j for t in chosen)
                assert held == bool(hashes[k * imatch.PER_LEVEL + j])


def test_an_edit_leaves_more_than_another_document(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = imatch.op5_imatch(docs).toPandas()
    assert found["near_edited"].between(0, 1).all() and found["near_next"].between(0, 1).all()
    assert (found["near_edited"] > found["near_next"]).mean() > 0.95


def test_the_plan_is_native_and_moves_texts_once(small):
    plan = imatch.op5_imatch(small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    assert plan.count("Exchange hashpartitioning") == 2  # by bucket, and the terms' counts


def test_empty_table(nothing):
    assert imatch.op5_imatch(nothing).count() == 0
