"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import (
    byte_bpe, exact_dedup, lexical, licenses, lm, packing, phrases, quality, simhash, token_files, topk, toxicity,
    url_reputation,
)
from tidepanel.session import scratch_path

#: Verdict, host and path of each rule.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
END_OF_FILE_TEXT = 2
END_OF_PACKED_TEXT = 0
#: Memos of queries that run alone; the pipeline, whose workers hold more, keeps the default.
WIDE_MEMO = 112 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _library() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, *_library(), END_OF_FILE_TEXT, memo_bytes=WIDE_MEMO)
    return token_files.read_token_digests(spark, path)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), *_library())


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *_library(), END_OF_PACKED_TEXT, memo_bytes=WIDE_MEMO)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_reputation.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "labelled", "bad")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


REGISTRY = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_token_files, op3_lm_scoring, op4_toxicity, op5_exact_topk,
        op6_best_fit_packing, op7_url_filters, op8_byte_bpe, op9_exact_dedup, op10_simhash,
        op11_phrase_mining, op12_lexical_search, op13_license_scan,
    )
}
