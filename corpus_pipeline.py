"""The corpus pipeline: five stages, each one operator, over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the
shared folder and reread as the next stage's docs, so an executor that is lost costs its tasks
and not the stages before. All stages but the last return the columns of documents.

1. language: documents whose language is rejected go (no letter, or a score under the threshold).
2. near_duplicates: one document of each group of near duplicates stays, the least doc_id.
3. decontaminate: spans that hold benchmark windows go; a document mostly made of them goes whole.
4. mixture: sources are repeated or thinned to their target weights.
5. shards: every row gets a shard and a slot, each shard with the mixture's proportions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import decontaminate, langid, mixing, neardup, sharding
from sievework.llm.tables import stored

SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    if "n_chars" not in docs.columns:
        return left
    # A shortened text has fewer characters than it came with.
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminated),
    ("mixture", mixture),
    ("shards", shards),
]

#: SQL cannot express the language model and the alignment; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
