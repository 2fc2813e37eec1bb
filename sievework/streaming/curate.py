"""The row-wise stages and first-wins exact dedup as a stream of page records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..functions.text import normalised
from ..operators.c4 import c4_filter
from ..operators.extract import extract
from ..operators.language import language_filter
from ..operators.pii import pii_filter
from ..operators.quality import gopher_filter
from ..plans.curate import dataset_rows
from ..schema import live, working

PAGES = "page_id long, url string, html string, seen timestamp"


def read_pages(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def curate_stream(pages: DataFrame, settings: Settings, watermark: str = "1 hour") -> DataFrame:
    """Kept rows. The state is one hash for each text seen within the watermark; the first copy wins, not the best."""
    rows = pages.withWatermark("seen", watermark)
    rows = working(rows.withColumnRenamed("page_id", "input_pos").withColumn("final_url", F.col("url")))
    rows = extract(rows, settings.extract).drop("html").transform(language_filter, settings.language).transform(gopher_filter, settings.gopher).where(live())
    rows = rows.withColumn("exact_hash", F.sha1(normalised(F.col("text")).cast("binary"))).withColumn("doc_id", F.col("exact_hash"))
    if settings.dedup.enabled and settings.dedup.exact_dedup:
        rows = rows.dropDuplicatesWithinWatermark(["exact_hash"])
    return rows.transform(c4_filter, settings.c4).transform(pii_filter, settings.pii).where(live())


def write_stream(rows: DataFrame, out_dir: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch as one folder named by its number: a batch that is run again replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        dataset_rows(batch).drop("input_pos").write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={number}")

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
