"""Tables of documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a table for each core under which it is dealt anew.
SMALL = 64 << 20
#: Partitions for each core then.
PARTS = 3


def read_table(spark: SparkSession, location: str, key: str | None = None) -> DataFrame:
    """A Parquet table, its work spread over all cores.

    A scan cannot split a row group, so a small table may come as one task. One that is too small
    to give each core a scan of its own is dealt by ``key``, which moves at most ``SMALL`` bytes a
    core; a larger one is read as it lies.
    """
    rows = spark.read.parquet(location)
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(location)
    size = path.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    parts = PARTS * context.defaultParallelism
    if size > SMALL * context.defaultParallelism:
        return rows
    return rows.repartition(parts, key) if key else rows.repartition(parts)
