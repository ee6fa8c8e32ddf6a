"""A corpus for training from the documents table: filter, deduplicate, decontaminate, mask, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railgauge.llm import common, decontamination, near_duplicates, packing, personal, quality
from railgauge.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.drop_poor(docs, common.read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With one document of each group of near-duplicates."""
    return near_duplicates.drop_near_duplicates(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of the benchmark."""
    return decontamination.drop_leaks(docs, common.read(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind; n_chars follows the text."""
    masked = personal.mask_personal_data(docs, personal.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), window=4096, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_personal", mask_personal),
    ("pack", pack),
]

#: No SQL states a trained model's decisions; the tests compare each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole documents table."""
    docs = common.read(spark, sf_dir, "documents")
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
