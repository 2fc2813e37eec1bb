"""Personal data: count, redact or drop. Native; each pattern sees what the ones before it left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Pii
from ..functions.pii import KINDS, count, replace
from ..schema import first_reason, live


def pii_counts(df: DataFrame, cfg: Pii, column: str = "text") -> DataFrame:
    """Add _pii_<kind> counts, and _pii_text, the text as redaction leaves it (mode redact) or as it is."""
    wanted = {"email": cfg.redact_email, "phone": cfg.redact_phone, "ip": cfg.redact_ip}
    out = df.withColumn("_pii_text", F.coalesce(F.col(column), F.lit("")))
    for kind, pattern, token in KINDS:
        if wanted[kind]:
            out = out.withColumn(f"_pii_{kind}", count(F.col("_pii_text"), pattern))
            if cfg.mode == "redact":
                out = out.withColumn("_pii_text", F.when(F.col(f"_pii_{kind}") > 0, replace(F.col("_pii_text"), pattern, token)).otherwise(F.col("_pii_text")))
        else:
            out = out.withColumn(f"_pii_{kind}", F.lit(0))
    return out


def pii_filter(df: DataFrame, cfg: Pii) -> DataFrame:
    """Set pii_matches, pii_types and pii_redacted of live rows; redact their text or drop them."""
    if not cfg.enabled:
        return df
    out = pii_counts(df, cfg)
    kinds = [k for k, _, _ in KINDS]
    matches = F.col("_pii_email") + F.col("_pii_phone") + F.col("_pii_ip")
    types = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"_pii_{k}") > 0, F.lit(k)) for k in kinds])))
    out = out.withColumn("pii_matches", F.when(live(), matches.cast("int")).otherwise(F.col("pii_matches")))
    out = out.withColumn("pii_types", F.when(live(), types).otherwise(F.col("pii_types")))
    if cfg.mode == "redact":
        hit = live() & (F.col("pii_matches") > 0)
        out = out.withColumn("text", F.when(hit, F.col("_pii_text")).otherwise(F.col("text"))).withColumn("pii_redacted", F.when(hit, F.lit(True)).otherwise(F.coalesce("pii_redacted", F.lit(False))))
    else:
        most = cfg.drop_if_pii_matches_gte
        out = out.withColumn("drop", first_reason("pii", [("pii_drop", F.col("pii_matches") >= most, F.format_string(f"matches=%d >= {most}", F.col("pii_matches")))]))
        out = out.withColumn("pii_redacted", F.coalesce("pii_redacted", F.lit(False)))
    return out.drop("_pii_text", *[f"_pii_{k}" for k in kinds])
