"""Proportional stratified interleaving into shards.

Rows of each source are shuffled by a seed and ranked; row r of a source of n rows stands at
the fraction (r + 1/2) / n. Sorted by that fraction, every stretch of the table holds the
sources in the mixture's proportions, so cutting the order into equal counts gives shards that
match the mixture. The law kept is ``rows``: counts of shards differ by one at most. It does not
keep equal texts together: copies are rows with places of their own.

Both ranks are exact and need no single-task sort (see :mod:`ranks`).

Defined results: a null source is a source of its own, sorted first among equal fractions; a
null text has no bytes; repeated rows are rows like others (ties are interchangeable); an empty
table gives no rows; a very long text is read and not moved by ``assign``; in ``shard_rows`` input columns named
shard or slot are replaced, and others stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import attach, seeded, with_rank

#: Bytes a stored row takes besides its text.
ROW_BYTES = 16
BUCKETS = 4096


def _bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + ROW_BYTES


def _crc(text: str) -> Column:
    return F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("bigint")


def assign(docs: DataFrame, shards: int, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Columns doc_id, size, text_crc32, source, law, shard, slot, grown_shard for every row; texts are read, not moved."""
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), _bytes(text_col).alias("size"), _crc(text_col).alias("text_crc32"))
    rows = rows.withColumn("_u", seeded(seed, "doc_id"))
    rows = rows.withColumn("_b", F.shiftright("_u", 48).cast("int"))
    ranked = with_rank(rows, ["source"], "_b", ["_u", "doc_id", "text_crc32", "size"], "_r")
    ranked = ranked.withColumn("_f", (F.col("_r") + 0.5) / F.col("_r_of"))
    ranked = ranked.withColumn("_g", F.floor(F.col("_f") * BUCKETS).cast("int"))
    placed = with_rank(ranked, [], "_g", ["_f", "source", "_u", "doc_id", "text_crc32", "size"], "_p")
    shard = F.expr(f"_p * {shards} div _p_of")
    return placed.select(
        "doc_id", "size", "text_crc32", "source", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
        F.expr(f"_p - ((_p * {shards} div _p_of) * _p_of + {shards - 1}) div {shards}").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_rows(docs: DataFrame, shards: int, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with shard and slot appended: write with partitionBy("shard") and sort by slot."""
    placed = assign(docs, shards, seed, id_col, text_col, source_col)
    keys = [F.col(id_col), F.col(source_col), _crc(text_col), _bytes(text_col)]
    return attach(docs, keys, placed, ["doc_id", "source", "text_crc32", "size"], ["shard", "slot"])
