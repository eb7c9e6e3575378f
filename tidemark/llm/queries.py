"""Registered queries of these operators: each reads its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import ann_forest, divergence, exact_topk, jaccard_join, language, licenses, packing, piece_bpe, quality_lm, simhash, token_scan, toxicity, trie_codes
from tidemark.llm.common import load, ship


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"), length=3, distance=3)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.scored(toxicity.train(docs, load(spark, sf_dir, "labels")), docs, threshold=0.7)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), capacity=2048, end_id=1)


def op4_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "embeddings")
    return ann_forest.nearest(table, table.where("vec_id % 50 = 0"), k=5)


def op5_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"), order=5, quantile=0.99)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = load(spark, sf_dir, "embeddings")
    return exact_topk.top_k(table, table.where("vec_id % 20 = 0"), k=20, factor=64)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(load(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(load(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return language.identify(language.train(docs), docs)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(load(spark, sf_dir, "documents"), min_docs=3, top=200)


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(load(spark, sf_dir, "documents"), length=3, percent=90)


def op13_trie_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_codes.compress(load(spark, sf_dir, "embeddings"), factor=4096, parts=8, entries=16, rounds=6)


def _shipped(query: Callable[[SparkSession, str], DataFrame]):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_ALL = (
    op1_simhash,
    op2_toxicity,
    op3_packing,
    op4_ann_forest,
    op5_quality_lm,
    op6_licenses,
    op7_exact_topk,
    op8_token_counts,
    op9_sentencepiece,
    op10_language,
    op11_divergence,
    op12_jaccard,
    op13_trie_codes,
)
_SQL = {
    "op6_licenses": licenses.SCAN_SQL,
    "op7_exact_topk": exact_topk.TOP_K_SQL,
    "op11_divergence": divergence.AUDIT_SQL,
    "op12_jaccard": jaccard_join.LINKED_SQL,
    "op13_trie_codes": trie_codes.COMPRESS_SQL,
}

#: name -> (query, SQL or None)
QUERIES = {q.__name__: (_shipped(q), _SQL.get(q.__name__)) for q in _ALL}
