"""Sharded output: consecutive chunks of the input order, one file each."""

from __future__ import annotations

import itertools
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Positions of one ranking bucket.
SPAN = 1 << 16


def with_shard(rows: DataFrame, shard_size: int, position: str = "input_pos") -> DataFrame:
    """Append shard_id: rank by position, cut every ``shard_size`` rows.

    Ranks are exact without one sort of all rows: counts of position buckets give offsets, and
    rows are ranked inside their bucket.
    """
    marked = rows.withColumn("_b", F.floor(F.col(position) / SPAN))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy("_b").agg(F.count("*").alias("_n")).select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(position)) - 1
    rank = F.col("_before") + F.col("_in")
    return marked.withColumn("_in", inside).join(offsets, "_b").withColumn("shard_id", F.floor(rank / shard_size).cast("int")).drop("_b", "_in", "_before")


def write_shards(rows: DataFrame, out_dir: str, columns: list[str], fmt: str = "parquet", shard_size: int = 50000) -> int:
    """Write <out_dir>/shards/shard_00000.<fmt> and on, replacing older shards; the number of shards.

    Every shard is written as one file by one task of a distributed job (whatever the session's limit
    of records a file), in a temporary folder of the same store. The new shards are complete, and
    counted, before the old ones go.
    """
    if fmt not in ("parquet", "jsonl"):
        raise ValueError(f"format {fmt!r}")
    spark = rows.sparkSession
    target, temporary, made, old = (f"{out_dir.rstrip('/')}/{name}" for name in ("shards", "_shards_tmp", "_shards_new", "_shards_old"))
    cut = with_shard(rows.select("input_pos", *columns), shard_size)
    writer = cut.repartition("shard_id").sortWithinPartitions("shard_id", "input_pos").drop("input_pos").write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy("shard_id")
    writer.parquet(temporary) if fmt == "parquet" else writer.option("ignoreNullFields", "false").json(temporary)
    fs, path = _store(spark, temporary)
    for left_over in (made, old):
        fs.delete(path(left_over), True)
    fs.mkdirs(path(made))

    def place(folder) -> None:
        files = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise RuntimeError(f"{folder.getName()} has {len(files)} files")
        if not fs.rename(files[0], path(f"{made}/shard_{int(folder.getName()[9:]):05d}.{fmt}")):
            raise RuntimeError(f"{files[0]} cannot be renamed")

    folders = [f.getPath() for f in fs.listStatus(path(temporary)) if f.getPath().getName().startswith("shard_id=")]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(place, folders))
    if fs.exists(path(target)) and not fs.rename(path(target), path(old)):
        raise RuntimeError(f"{target} cannot be replaced")
    if not fs.rename(path(made), path(target)):
        raise RuntimeError(f"{made} cannot be renamed; the former shards are in {old}")
    for done in (old, temporary):
        fs.delete(path(done), True)
    return len(folders)


def _store(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(location).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def write_text(spark: SparkSession, location: str, text: str | Iterable[str]) -> None:
    """A driver-side file in whatever store the location names, from one string or piece by piece."""
    fs, path = _store(spark, location)
    out = fs.create(path(location), True)
    pieces = iter((text,) if isinstance(text, str) else text)
    try:
        while part := list(itertools.islice(pieces, 10_000)):
            out.write(bytearray("".join(part).encode("utf-8")))
    finally:
        out.close()


def first_shard(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The first Parquet shard by name, or None."""
    fs, path = _store(spark, out_dir)
    folder = path(f"{out_dir.rstrip('/')}/shards")
    if not fs.exists(folder):
        return None
    names = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet"))
    return spark.read.parquet(f"{out_dir.rstrip('/')}/shards/{names[0]}") if names else None
