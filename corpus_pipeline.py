"""The corpus pipeline: documents through five training-data operators.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents``.  The mix repeats a document once per epoch that
takes it, as training does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, jaccard_join, length_buckets, quality_bands, secret_scan, source_mix


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go."""
    return quality_bands.keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a Jaccard similarity of 0.8 on five-word
    shingles the document with the smallest doc_id stays."""
    return jaccard_join.keep_one(docs, n=5, num=80, den=100)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares, documents repeated by epoch."""
    return source_mix.apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-budget batches inside optimal length buckets."""
    return length_buckets.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", deduplicate),
    ("secret_scans", secrets),
    ("source_mix", mixture),
    ("packing", packing),
]

# stages 1, 2 and 4 rest on zstandard, 64-bit set hashes and seeded draws
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    tables = common.Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tables.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
