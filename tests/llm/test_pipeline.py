"""The pipeline's stages, each on what its predecessor kept, against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from pathproof.llm import toxicity
from pathproof.llm.common import stored
from tests.llm.test_line_dedup import expected
from tests.llm.test_packing import ids_of
from tests.llm.test_simhash import fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    """(name, input, output) of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF))
        out.append((name, docs, after))
        docs = after
    return out


def rows(df) -> list[tuple]:
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_and_columns(frames):
    assert [n for n, _, _ in frames] == ["language", "toxicity", "line_dedup", "near_copies", "packing"]
    for _, before, after in frames[:-1]:
        assert after.schema.fieldNames() == before.schema.fieldNames()
        assert dict(after.dtypes) == dict(before.dtypes)


def test_language_keeps_clean_documents(frames):
    assert rows(frames[0][1]) == rows(frames[0][2])


def test_toxicity_keeps_what_scores_below_the_limit(spark, frames):
    _, before, after = frames[1]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert rows(after) == [(i, t) for i, t in rows(before) if model.score(t)[0] < toxicity.REJECT]


def test_line_dedup_keeps_the_first_line_of_each_class(frames):
    _, before, after = frames[2]
    answer = expected(rows(before))
    want = []
    for i, t in rows(before):
        lines = t.split("\n")
        want.append((i, "\n".join(x for k, x in enumerate(lines) if answer.get((i, k), [(0, 0, True)])[0][2])))
    assert rows(after) == want
    assert after.where(F.col("n_chars") != F.length("text")).count() == 0


def test_one_document_of_each_group_of_near_copies(frames):
    """Groups by comparing all fingerprints of runs of three words."""
    _, before, after = frames[3]
    docs = rows(before)
    prints = [fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, doc in enumerate(docs):
        groups[find(i)].append((doc[0], hashlib.md5(doc[1].encode()).hexdigest(), doc))
    assert rows(after) == sorted(min(g)[2] for g in groups.values())


def test_packing_holds_every_id(frames):
    _, before, after = frames[4]
    parts = defaultdict(list)
    for r in after.collect():
        parts[r.doc_id].append((r.start, r.ids))
    want = {i: ids_of(t).tolist() for i, t in rows(before)}
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in parts.items()} == want


def test_run_is_registered_and_equals_the_stages(spark, frames):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, out.collect())) == sorted(map(str, frames[-1][2].collect()))


def test_stages_on_edge_cases_and_empty_tables(spark, edge, nothing):
    for docs in (edge, nothing):
        columns, count = docs.columns, docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF))
            assert docs.columns == columns and docs.count() <= count
        assert stored(corpus_pipeline.STAGES[-1][1](spark, docs, SF)).count() >= docs.count()
