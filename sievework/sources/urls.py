"""URL lists as (input_pos, raw_url)."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.url_filter import ordered_distinct

_SCHEMA = "input_pos long, raw_url string"


def urls_from_text(spark: SparkSession, text: str, comments: bool = False) -> DataFrame:
    """One URL a line; blank lines are left out, and with ``comments`` those that start with #."""
    found = [u for line in text.splitlines() if (u := line.strip()) and not (comments and u.startswith("#"))]
    return spark.createDataFrame(list(enumerate(found)), _SCHEMA)


def urls_from_list(spark: SparkSession, urls: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(urls)), _SCHEMA)


def urls_from_file(spark: SparkSession, path: str, comments: bool = False) -> DataFrame:
    """A text file, or a folder of them, of any size; the position follows the files' names and the lines' order.

    Spark deals splits of files in an order of its own, so lines are numbered inside their split
    and the splits (one row each) are counted in the order of path and offset.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("m"))
    counts = lines.groupBy("p", "s").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("p", "s").rowsBetween(Window.unboundedPreceding, -1))
    splits = counts.select("p", "s", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("p", "s").orderBy("m")) - 1
    lines = lines.withColumn("i", inside).join(splits, ["p", "s"])
    lines = lines.select((F.col("before") + F.col("i")).alias("input_pos"), strip(F.regexp_replace("value", "�", "")).alias("raw_url")).where("raw_url != ''")
    return lines.where(~F.col("raw_url").startswith("#")) if comments else lines


def urls_from_stdin(spark: SparkSession) -> DataFrame:
    if sys.stdin is None or sys.stdin.isatty():
        raise ValueError("no URLs: give a text, a file or standard input")
    return urls_from_text(spark, sys.stdin.read())


def read_urls(spark: SparkSession, text: str | None = None, path: str | None = None) -> DataFrame:
    """From the text, else the file, else standard input."""
    if text:
        return urls_from_text(spark, text)
    return urls_from_file(spark, path) if path else urls_from_stdin(spark)


def pasted_urls(spark: SparkSession, pasted: str = "", uploaded: str = "") -> DataFrame:
    """Pasted and uploaded lists together, comments left out, each URL once."""
    return ordered_distinct(urls_from_text(spark, f"{pasted or ''}\n{uploaded or ''}", comments=True))
