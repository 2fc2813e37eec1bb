"""Run statistics as aggregates (accumulators would count retried tasks twice)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import live

#: Stages whose drops the histogram counts.
COUNTED = ("language", "gopher", "dedup_exact", "dedup_minhash", "c4", "pii")


def drop_counts(df: DataFrame, stages: tuple[str, ...] | None = COUNTED) -> DataFrame:
    """reason (stage:code) and n; ``stages`` None counts every stage."""
    dropped = df.where(~live())
    if stages is not None:
        dropped = dropped.where(F.col("drop.stage").isin(*stages))
    return dropped.groupBy(F.concat_ws(":", "drop.stage", "drop.code").alias("reason")).agg(F.count("*").alias("n"))


def totals(df: DataFrame) -> DataFrame:
    """One row: fetched, extracted, kept, dropped and total. Exact duplicates are in none of the last three."""
    stage = F.coalesce(F.col("drop.stage"), F.lit(""))
    counted = stage != "dedup_exact"
    return df.agg(
        F.count_if(F.col("status_code").isNotNull() & (stage != "fetch")).alias("fetched"),
        F.count_if(F.col("text").isNotNull() & ~stage.isin("fetch", "extract")).alias("extracted"),
        F.count_if(live()).alias("kept"),
        F.count_if(~live() & counted).alias("dropped"),
        F.count_if(counted).alias("total"),
    )
