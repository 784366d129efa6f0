"""One query per operator over its whole table, and the same rows in plain SQL where SQL can tell them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pathproof.llm import (
    embeddings,
    imatch,
    langid,
    linedup,
    packing,
    phrases,
    pieces,
    quality,
    search,
    simhash,
    tokencount,
    tokenfile,
    toxicity,
)
from pathproof.llm.common import table
from pathproof.llm.tokens import default_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_linedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.op1_linedup(table(spark, sf_dir, "documents"))


def op2_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.op2_tokencount(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op3_packing(table(spark, sf_dir, "documents"), default_path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op4_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.op5_imatch(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op6_simhash(table(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op7_langid(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.op8_tokenfile(table(spark, sf_dir, "documents"), default_path("word_bpe_49k.json"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op9_pieces(table(spark, sf_dir, "documents"), default_path("piece_bpe_32k.model"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.op10_embeddings(table(spark, sf_dir, "embeddings"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.op11_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.op12_phrases(table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op13_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_linedup": op1_linedup,
    "op2_tokencount": op2_tokencount,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_imatch": op5_imatch,
    "op6_simhash": op6_simhash,
    "op7_langid": op7_langid,
    "op8_tokenfile": op8_tokenfile,
    "op9_pieces": op9_pieces,
    "op10_embeddings": op10_embeddings,
    "op11_search": op11_search,
    "op12_phrases": op12_phrases,
    "op13_quality": op13_quality,
}

#: Token ids, hashes of Spark, classifiers and edit distances over all lines are beyond SQL; the tests compare those
#: queries with brute force.
ORACLES: dict[str, str] = {
    "op10_embeddings": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
                   coalesce(len(embedding) > 0
                            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                            AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
            FROM embeddings
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.usable AND b.usable AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ),
        reach(vec_id, other) AS (
            SELECT vec_id, vec_id FROM v
            UNION
            SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
        ),
        least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
        counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id, v.vec_id = component_id AS kept
        FROM v JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
    """,
    "op11_search": search.ORACLE_SQL,
    "op12_phrases": phrases.ORACLE_SQL,
}
