"""The queries of this package: one per operator, with production parameters on whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    fingerprints,
    lexical_search,
    near_duplicates,
    packing,
    periodic_runs,
    personal,
    preferences,
    quality,
    substrings,
    token_counts,
    urls,
    warc,
)
from .common import read, shared_folder, written
from .oracle import SQL


def tokenizer_path(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substrings.remove_repeats(read(spark, sf_dir, "documents"), span=35)
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), window=4096, end_id=2)


def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.request_pairs(read(spark, sf_dir, "conversations"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"), paragraph_words=8)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judge_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), most_rows=8000)


URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = personal.find_personal_data(docs, personal.train(docs))
    return found.withColumn("base", F.sha2("base", 256)).withColumnRenamed("base", "base_sha256")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=512)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"), k=4, percent=80)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_loops(read(spark, sf_dir, "documents"))))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    warc.write_archives(read(spark, sf_dir, "pages"), archives, least_bytes=1000)
    records = written(warc.read_records(spark, archives), "records")
    return warc.page_captures(written(warc.assemble(records), "captures"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_packing": op2_packing,
    "op3_preferences": op3_preferences,
    "op4_fingerprints": op4_fingerprints,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_url_filter": op7_url_filter,
    "op8_personal_data": op8_personal_data,
    "op9_token_counts": op9_token_counts,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_lexical_search": op12_lexical_search,
    "op13_warc": op13_warc,
}


__all__ = ["QUERIES", "SQL", "tokenizer_path"]
