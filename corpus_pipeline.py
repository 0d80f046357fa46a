"""The corpus pipeline: documents through five stages, each one operator of roasline.llm.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from roasline.llm import bpe, line_spread, mixing, quality_ngrams, simhash
from roasline.llm.queries import prepare, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    prepare(spark)
    model = quality_ngrams.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_ngrams.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share go; n_chars follows the text."""
    prepare(spark)
    cleaned = line_spread.remove_boilerplate(docs, F.col("source"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    prepare(spark)
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix_to_targets),
    ("bpe_encode", encode),
]

# SimHash (XXH64) and dependent rounding have no SQL form; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; stages are handed on as Parquet in the shared checkpoint folder."""
    folder = f"{prepare(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
