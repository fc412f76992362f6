"""The queries of this subpackage: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import archives, crosspoly, divergence, exact_dedup, line_dedup, mixing, pieces, pii, ranked, simhash, token_counts, topk, toxicity
from fathomline.llm.common import scratch, table
from fathomline.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


def op7_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.convert_pages(spark, table(spark, sf_dir, "pages"), scratch(spark, "warc"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspoly.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_mix_sources, op2_toxicity, op3_simhash, op4_topk_search, op5_exact_dedup, op6_pieces, op7_archives, op8_token_counts, op9_line_dedup, op10_pii, op11_nearest, op12_divergence, op13_ranked_search)
}
