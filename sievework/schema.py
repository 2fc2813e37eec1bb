"""Fixed schemas, and the one structured reason that a dropped row carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DROP = T.StructType([T.StructField(n, T.StringType()) for n in ("stage", "code", "detail")])

#: The working record: what stages read and add to.
WORKING = T.StructType(
    [
        T.StructField("input_pos", T.LongType(), False), T.StructField("url", T.StringType()), T.StructField("domain", T.StringType()),
        T.StructField("fetched_at", T.LongType()), T.StructField("status_code", T.IntegerType()), T.StructField("content_type", T.StringType()),
        T.StructField("final_url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("fetch_error", T.StringType()),
        T.StructField("extract_error", T.StringType()), T.StructField("title", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("extracted_at", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("lang_conf", T.DoubleType()),
        T.StructField("quality_score", T.DoubleType()), T.StructField("doc_id", T.StringType()), T.StructField("exact_hash", T.StringType()),
        T.StructField("minhash_cluster_id", T.StringType()), T.StructField("pii_redacted", T.BooleanType()),
        T.StructField("pii_types", T.ArrayType(T.StringType())), T.StructField("pii_matches", T.IntegerType()), T.StructField("drop", DROP),
    ]
)

#: The output contract, in column order.
OUTPUT = T.StructType(
    [
        T.StructField("doc_id", T.StringType()), T.StructField("url", T.StringType()), T.StructField("domain", T.StringType()),
        T.StructField("fetched_at", T.LongType()), T.StructField("title", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("lang_conf", T.DoubleType()), T.StructField("quality_score", T.DoubleType()),
        T.StructField("dedup_cluster_id", T.StringType()), T.StructField("pii_redacted", T.BooleanType()),
        T.StructField("pii_types", T.ArrayType(T.StringType())), T.StructField("filters_triggered", T.ArrayType(T.StringType())),
    ]
)


def reason(stage: str, code: Column | str, detail: Column | str | None = None) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    detail = F.lit(detail) if detail is None or isinstance(detail, str) else detail
    return F.struct(F.lit(stage).alias("stage"), code.alias("code"), detail.cast("string").alias("detail"))


def working(df: DataFrame) -> DataFrame:
    """``df`` with every column of the working record; absent ones are null, further ones stay."""
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in WORKING], *[c for c in df.columns if c not in WORKING.names])


def live() -> Column:
    return F.col("drop").isNull()


def first_reason(stage: str, rules: list[tuple[str, Column, Column | str | None]]) -> Column:
    """The drop column after a stage: what it was, else the first rule that holds, else null."""
    out = F.lit(None).cast(DROP)
    for code, test, detail in reversed(rules):
        out = F.when(test, reason(stage, code, detail)).otherwise(out)
    return F.when(live(), out).otherwise(F.col("drop"))
