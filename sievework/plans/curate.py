"""The curation plan: URLs or pages to a cleaned, sharded corpus with run statistics."""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, is_dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.urls import SUFFIXES, Suffixes, url_domain
from ..operators.c4 import c4_filter
from ..operators.dedup import exact_dedup, minhash_dedup
from ..operators.extract import extract
from ..operators.language import language_filter, language_histogram
from ..operators.pii import pii_filter
from ..operators.quality import gopher_filter
from ..operators.stats import drop_counts, totals
from ..operators.url_filter import filter_urls
from ..schema import OUTPUT, live, working
from ..sources import http
from ..sources.shards import write_shards, write_text
from .shared import stored


@dataclass(frozen=True)
class RunSummary:
    total: int
    kept: int
    dropped: int
    shards_written: int
    dataset_dir: str
    stats_path: str | None = None
    summary_path: str | None = None


def curate_text(docs: DataFrame, settings: Settings) -> DataFrame:
    """All stages after extraction, over a table with input_pos and text. Order matters: dedup comes before C4 and PII."""
    out = docs.transform(working).transform(language_filter, settings.language).transform(gopher_filter, settings.gopher)
    # Both dedup stages write what comes to them, so detectors and metrics are computed once.
    out = out.transform(exact_dedup, settings.dedup).transform(minhash_dedup, settings.dedup)
    return out.transform(c4_filter, settings.c4).transform(pii_filter, settings.pii)


def curate_pages(fetched: DataFrame, settings: Settings) -> DataFrame:
    """From fetched rows (the working record with html) on."""
    return curate_text(extract(working(fetched), settings.extract).drop("html"), settings)


def dataset_rows(df: DataFrame) -> DataFrame:
    """input_pos and the output contract, of kept rows."""

    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    doc_id = F.coalesce("doc_id", F.sha1(F.coalesce("text", "url").cast("binary")))
    rows = df.where(live()).select(
        "input_pos", doc_id.alias("doc_id"), F.coalesce(F.nullif(F.col("final_url"), F.lit("")), "url").alias("url"),
        F.coalesce(F.nullif(F.col("domain"), F.lit("")), url_domain(F.col("url"))).alias("domain"), F.coalesce("fetched_at", F.unix_timestamp()).alias("fetched_at"),
        text("title").alias("title"), text("text").alias("text"), text("lang").alias("lang"),
        F.coalesce("lang_conf", F.lit(0.0)).alias("lang_conf"), F.coalesce("quality_score", F.lit(0.0)).alias("quality_score"), text("minhash_cluster_id").alias("dedup_cluster_id"),
        F.coalesce("pii_redacted", F.lit(False)).alias("pii_redacted"), F.coalesce("pii_types", F.array().cast("array<string>")).alias("pii_types"),
        F.when(live(), F.array().cast("array<string>")).otherwise(F.array(F.concat_ws(":", "drop.stage", "drop.code"))).alias("filters_triggered"),
    )
    return rows.select("input_pos", *[F.col(f.name).cast(f.dataType) for f in OUTPUT])


def audit_rows(df: DataFrame) -> DataFrame:
    """One row for every document, kept or not: what became of it."""
    return df.select(
        "input_pos", "url", "status_code", F.when(live(), "ok").otherwise("dropped").alias("status"), "lang", "quality_score",
        F.concat_ws(":", "drop.stage", "drop.code").alias("reason"), F.col("drop.detail").alias("detail"), F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
    )


def preview_rows(rows: DataFrame, limit: int = 50) -> DataFrame:
    """Six columns of the first rows; text cut to 220 characters."""
    cut = F.when(F.length("text") > 220, F.concat(F.substring("text", 1, 220), F.lit("…"))).otherwise(F.coalesce("text", F.lit("")))
    order = rows.orderBy("input_pos") if "input_pos" in rows.columns else rows
    return order.limit(limit).select("url", "title", "lang", F.coalesce("lang_conf", F.lit(0.0)).alias("lang_conf"), F.coalesce("quality_score", F.lit(0.0)).alias("quality_score"), cut.alias("text_preview"))


def record_at(rows: DataFrame, index: int) -> dict | None:
    """The full record at an index of the order, for a detail view or export."""
    order = rows.orderBy("input_pos") if "input_pos" in rows.columns else rows
    found = order.offset(index).limit(1).collect()
    return found[0].asDict(recursive=True) if found else None


def json_safe(value):
    """The value as JSON takes it: keys as text, sets and tuples as lists, anything else by its text."""
    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, frozenset)):
        return [json_safe(v) for v in (sorted(value, key=str) if isinstance(value, (set, frozenset)) else value)]
    if is_dataclass(value) and not isinstance(value, type):
        return json_safe(asdict(value))
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def json_lines(rows: Iterable[Row]) -> Iterator[str]:
    """A line of JSON for each row; preview and record exports hold what they show, not the whole dataset."""
    for r in rows:
        yield json.dumps(json_safe(r.asDict(recursive=True)), ensure_ascii=False) + "\n"


def run(urls: DataFrame, settings: Settings, out_dir: str, export_format: str | None = None, scan=None, max_urls: int | None = None, suffixes: Suffixes = SUFFIXES) -> RunSummary:
    """Curate a URL list (input_pos, raw_url) into ``out_dir``. ``scan`` makes fetched rows of filtered URLs; by default over HTTP."""
    spark, started = urls.sparkSession, int(time.time())
    fmt = export_format or settings.output.format
    if max_urls:
        urls = urls.orderBy("input_pos").limit(max_urls)
    wanted = filter_urls(urls, settings.url_filter, suffixes)
    fetched = stored(scan(wanted) if scan else http.fetch(wanted, settings.fetch), "fetched")
    done = stored(curate_pages(fetched, settings), "curated")
    shards = write_shards(dataset_rows(done), out_dir, OUTPUT.names, fmt, settings.output.shard_size)
    t = totals(done).first()
    stats_path = None
    if settings.output.write_stats:
        stats_path = f"{out_dir.rstrip('/')}/stats.json"
        stats = {
            "started_at": started, "finished_at": int(time.time()), "total_urls": urls.count(), "fetched": t["fetched"], "extracted": t["extracted"], "kept": t["kept"], "dropped": t["dropped"],
            "drop_counts": {r["reason"]: r["n"] for r in drop_counts(done).orderBy("reason").collect()}, "lang_counts": {r["lang"]: r["n"] for r in language_histogram(done).orderBy("lang").collect()},
            "output_format": fmt, "shards_written": shards,
        }
        write_text(spark, stats_path, json.dumps(json_safe(stats), indent=2, ensure_ascii=False))
    summary = RunSummary(t["total"], t["kept"], t["dropped"], shards, out_dir, stats_path, f"{out_dir.rstrip('/')}/summary.json")
    write_text(spark, summary.summary_path, json.dumps(json_safe(summary), indent=2))
    return summary
