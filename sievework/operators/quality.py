"""Gopher-style quality heuristics and score. Native; metrics are computed once in a projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Gopher
from ..functions import text as t
from ..schema import first_reason, live

METRICS = ("word_count", "digit_ratio", "symbol_ratio", "upper_ratio", "rep_frac")


def metrics(text: Column) -> Column:
    """struct of the five metrics."""
    text = F.coalesce(text, F.lit(""))
    chars, letters = F.greatest(F.length(text), F.lit(1)), F.greatest(t.count_chars(text, t.LETTER), F.lit(1))
    return F.struct(
        t.word_count(text).cast("long").alias("word_count"), (t.count_chars(text, t.DIGIT) / chars).alias("digit_ratio"),
        ((F.length(text) - t.count_chars(text, t.PLAIN)) / chars).alias("symbol_ratio"), (t.count_chars(text, t.UPPER) / letters).alias("upper_ratio"),
        t.repeated_fraction(text).alias("rep_frac"),
    )


def score(m: str, cfg: Gopher) -> Column:
    """The quality score; terms are added in a fixed order so that doubles agree."""

    def part(name: str, most: float) -> Column:
        return F.least(F.col(f"{m}.{name}") / F.lit(most + 1e-9), F.lit(1.0)) * 0.2

    value = F.lit(1.0) - part("symbol_ratio", cfg.max_symbol_ratio) - part("digit_ratio", cfg.max_digit_ratio) - part("rep_frac", cfg.repetition_threshold)
    value = value + F.least(F.col(f"{m}.word_count") / 1000.0, F.lit(1.0)) * 0.2
    return F.greatest(F.lit(0.0), F.least(F.lit(1.5), value))


def rules(m: str, cfg: Gopher) -> list:
    def over(code: str, name: str, most: float):
        return code, F.col(f"{m}.{name}") > most, F.format_string(f"{name}=%.3f > {most}", F.col(f"{m}.{name}"))

    n = F.col(f"{m}.word_count")
    return [
        ("too_few_words", n < cfg.min_words, F.format_string(f"words=%d < {cfg.min_words}", n)),
        ("too_many_words", n > cfg.max_words, F.format_string(f"words=%d > {cfg.max_words}", n)),
        over("symbol_ratio", "symbol_ratio", cfg.max_symbol_ratio),
        over("digit_ratio", "digit_ratio", cfg.max_digit_ratio),
        over("upper_ratio", "upper_ratio", cfg.max_upper_ratio),
        over("repetition", "rep_frac", cfg.repetition_threshold),
    ]


def gopher_filter(df: DataFrame, cfg: Gopher) -> DataFrame:
    """Add quality_score, metrics (of passing rows) and the first of six drop codes."""
    if not cfg.enabled:
        return df.withColumn("quality_score", F.when(live(), F.lit(1.0)).otherwise(F.col("quality_score")))
    out = df.withColumn("_m", metrics(F.col("text"))).withColumn("drop", first_reason("gopher", rules("_m", cfg)))
    out = out.withColumn("quality_score", F.when(live(), score("_m", cfg)).otherwise(F.col("quality_score")))
    return out.withColumn("metrics", F.when(live(), F.col("_m"))).drop("_m")
