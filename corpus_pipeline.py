"""From raw documents to packed training sequences, in five stages over whole tables.

1. Quality rules: failing lines go, documents that lose too much or fail the base measures go.
2. N-gram Jaccard join: of each group of near copies, the document with the smallest doc_id stays.
3. Substring dedup: words covered by a passage of 20 words that starts earlier go; documents left without words go.
4. Benchmark decontamination: documents holding a passage aligned with a test item go.
5. Best-fit packing: what is left is encoded, cut and packed by minimum bin slack.

Each stage reads what the stage before has written. Null or empty texts fall at stage 1, repeated rows at
stage 2; other columns pass through to stage 4; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowtide.llm import decontaminate, ngram_join, packing, quality, substring
from flowtide.llm.tables import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.cut(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("best-fit packing", packed_sequences),
]

#: Packing and alignment have no SQL; tests/llm holds a brute-force version of the whole pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, f"stage-{number + 1}")
    return docs
