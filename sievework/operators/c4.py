"""C4-style rules. Native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import C4
from ..functions import text as t
from ..schema import first_reason


def first_phrase(text: Column, phrases: tuple[str, ...]) -> Column:
    """The first phrase of the list that the lower-cased text holds, else null."""
    low = F.lower(text)
    out = F.lit(None).cast("string")
    for p in reversed(phrases):
        out = F.when(F.contains(low, F.lit(p.lower())), F.lit(p)).otherwise(out)
    return out


def c4_filter(df: DataFrame, cfg: C4) -> DataFrame:
    if not cfg.enabled:
        return df
    text = F.coalesce(F.col("text"), F.lit(""))
    out = df.withColumn("_c", F.struct(first_phrase(text, cfg.blacklist_phrases).alias("phrase"), t.sentence_count(text).alias("sentences"), t.stopword_fraction(text).alias("stop")))
    drop = first_reason(
        "c4",
        [
            ("blacklist_phrase", F.col("_c.phrase").isNotNull(), F.col("_c.phrase")),
            ("too_few_sentences", F.col("_c.sentences") < cfg.min_sentences, F.format_string(f"sentences=%d < {cfg.min_sentences}", F.col("_c.sentences"))),
            ("low_stopword_fraction", F.coalesce(F.col("_c.stop") < cfg.min_stopword_fraction, F.lit(False)), F.format_string(f"stopwords=%.3f < {cfg.min_stopword_fraction}", F.col("_c.stop"))),
        ],
    )
    return out.withColumn("drop", drop).withColumn("stopword_fraction", F.col("_c.stop")).drop("_c")
