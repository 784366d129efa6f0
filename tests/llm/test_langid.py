from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathproof.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.train(docs)


def test_pages_by_brute_force(spark, docs, model):
    """The same posterior, page by page, from the evidence of all pages."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").limit(120)
    rows = [r.asDict() for r in langid.page_evidence(pages, model).collect()]
    n = len(model.languages)
    for r in rows:
        logs = np.array([r[f"l{i}"] for i in range(n)])
        r["p"] = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum() if r["n"] else np.zeros(n)
    one = {True: 1.0, False: 0.0}
    whole = sum(r["p"] for r in rows)
    general = (whole + 1) / (sum(one[r["n"] > 0] for r in rows) + n)
    got = {r.page_id: r for r in langid.fuse(langid.page_evidence(pages, model), model.languages).withColumnRenamed("id", "page_id").collect()}
    for r in rows:
        prior = general
        if langid.SUFFIX_LANGUAGE.get(r["suffix"]) in model.languages:
            prior = (general + np.array([float(x == langid.SUFFIX_LANGUAGE[r["suffix"]]) for x in model.languages])) / 2
        for level in ("suffix", "domain", "host"):
            others = [x for x in rows if x is not r and x[level] == r[level] and r[level] is not None]
            total = sum((x["p"] for x in others), np.zeros(n))
            prior = (total + 5 * prior) / (sum(one[x["n"] > 0] for x in others) + 5)
        said = np.ones(n)
        if r["declared"]:
            others = sum((x["p"] for x in rows if x is not r and x["declared"] == r["declared"]), np.zeros(n))
            trust = np.array([0.8 if x == r["declared"] else 0.2 / n for x in model.languages])
            said = (others + 20 * trust) / (whole + 20)
        logs = np.array([r[f"l{i}"] for i in range(n)]) + np.log(prior) + np.log(said)
        final = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
        assert got[r["id"]].lang == model.languages[int(final.argmax())]
        assert math.isclose(got[r["id"]].probability, final.max(), rel_tol=1e-9)


def test_pages_match_their_declaration(spark, docs):
    found = langid.op7_langid(spark.read.parquet(f"{SF}/pages.parquet"), docs).toPandas()
    pages, others = found[found["page_id"].notna()], found[found["doc_id"].notna()]
    assert len(pages) == 250 and len(others) == docs.count() and len(found) == len(pages) + len(others)
    assert (pages["lang"] == pages["declared"]).mean() > 0.99 and found["accepted"].all()
    right = others.merge(docs.select("doc_id", F.col("lang").alias("truth")).toPandas(), on="doc_id")
    assert (right["lang"] == right["truth"]).mean() > 0.99


def test_held_out_documents(spark, docs):
    rest = docs.where("doc_id % 2 = 0")
    model = langid.train(docs.where("doc_id % 2 = 1"))
    found = langid.fuse(langid.document_evidence(rest, model), model.languages)
    right = found.join(rest, found["id"] == rest["doc_id"]).agg(F.avg((found["lang"] == rest["lang"]).cast("double")))
    assert right.first()[0] > 0.99


def test_other_evidence_decides_short_pages(spark, docs):
    """A page without letters gets its host's language; a declaration outweighs two letters."""
    german = docs.where("lang = 'de'").limit(12).collect()
    pages = [(k, "http://a.example.de/x", f"<html><body>{r.text}</body></html>") for k, r in enumerate(german)]
    pages += [(100, "http://a.example.de/y", "<html><p>12 34</p></html>"), (101, None, None), (102, "no address", "<p>x"), (None, "http://b.fr", '<html lang="fr">12')]
    found = {r.page_id: r for r in langid.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert found[100].lang == "de" and not found[100].accepted and found[100].text_lang is None
    assert found[None].lang == "fr" and found[None].declared == "fr"
    assert len(found) == 16 and found[101].host is None and found[102].host is None


def test_parts_of_a_page():
    assert langid._DECLARED.search("<!DOCTYPE html><HTML class=a lang='fr-CA'>")[1] == "fr"
    assert langid._HOST.match("https://user:pw@WWW.Example.DE:8080/x")[1] == "WWW.Example.DE"
    assert langid.visible_text("a<script>x</script><!-- y --><b>c</b>&amp;").split() == ["a", "c", "&"]


def test_documents_without_letters_go(spark, edge):
    kept = langid.accepted_documents(edge)
    assert kept.columns == edge.columns
    gone = {(r["doc_id"]) for r in edge.join(kept.select("doc_id").distinct(), edge["doc_id"].eqNullSafe(kept["doc_id"]), "left_anti").collect()}
    assert gone == {4, 5, 6}


def test_clean_documents_stay(docs):
    assert langid.accepted_documents(docs).count() == docs.count()


def test_labelled_gibberish_and_foreign_texts_go(spark, docs):
    import random

    rnd = random.Random(5)
    odd = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)) for n in (60, 300, 3000)]
    odd.append("Это простой русский текст о лесе и о животных, которые в нём живут. " * 3)
    odd.append("Kissa istuu ikkunalla ja katselee lintuja, jotka lentävät korkealla taivaalla. " * 2)
    planted = [(10**9 + k, t, "en" if k % 2 else "de", "s", len(t)) for k, t in enumerate(odd)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    some = spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.select(*names).unionByName(some)
    kept = {r.doc_id for r in langid.accepted_documents(both).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}


def test_empty_tables(spark, nothing, docs):
    assert langid.accepted_documents(nothing).count() == 0
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert langid.identify_pages(none, docs).count() == 0
    assert langid.op7_langid(none, docs).count() == docs.count()
    pages = spark.createDataFrame([(1, "http://a.de/", '<html lang="de">Wort')], "page_id long, url string, html string")
    unknown = langid.op7_langid(pages, nothing).collect()
    assert [(r.page_id, r.lang, r.declared, r.accepted) for r in unknown] == [(1, None, "de", False)]


def test_a_plan_of_more_languages_grows_no_faster_than_their_number(spark):
    def size(n: int) -> int:
        kinds = ", ".join(["id long", "host string", "domain string", "suffix string", "declared string", "odd boolean", "n long"])
        evidence = spark.createDataFrame([], kinds + "".join(f", l{i} double" for i in range(n)))
        found = langid.fuse(evidence, [f"x{i}" for i in range(n)])
        return len(found._jdf.queryExecution().optimizedPlan().toString())

    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        assert size(8) < 3 * size(4)
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
