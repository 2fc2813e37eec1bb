"""The queries of this subpackage: thin digests of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, htmltext, langid, media, mixing, neardup, oracles, sharding, suffixarray, suffixtree, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.dedup(_documents(spark, sf_dir)).drop("kept")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held = toxicity.held_out("doc_id", 5, 0)
    found = langid.identify(docs, ~held)
    return found.select("doc_id", toxicity.held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "rejected")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(media.media(_documents(spark, sf_dir)))


def op4_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.dedup(_documents(spark, sf_dir)).drop("kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), _table(spark, sf_dir, "labels")
    held = toxicity.held_out("doc_id", 4, 2)
    found = toxicity.score(docs, labels, ~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(_documents(spark, sf_dir)).select("doc_id", "n_words", "class_id", "group_id", "group_size")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark")))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_shard_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_documents(spark, sf_dir), 40).drop("source")


def media_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op3 what SQL can state."""
    return op3_media_columns(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of op5 what SQL can state."""
    return op5_mix_sources(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_array_dedup, op2_language_id, op3_media_columns, op4_suffix_tree_dedup, op5_mix_sources, op6_toxicity, op7_shard_interleave, op8_html_text, op9_order_minhash, op10_decontaminate, media_payload, mix_targets)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
