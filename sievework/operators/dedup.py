"""Exact and MinHash near-duplicate removal, keyed by input position."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Dedup
from ..functions.text import normalised, shingles
from ..plans.shared import stored
from ..schema import live, reason
from .components import components

#: Modulus of the hash family: products of two residues stay below 2**62.
PRIME = 2**31 - 1
#: Shingles of which the permutations are made at a time.
BLOCK = 1 << 13


def preference(policy: str) -> Column:
    """Greatest is kept: by score then length, or by length; the earlier position wins ties."""
    length, early = F.length(F.coalesce("text", F.lit(""))), -F.col("input_pos")
    return F.struct(F.coalesce("quality_score", F.lit(0.0)), length, early) if policy == "highest_quality" else F.struct(length, early)


def exact_dedup(df: DataFrame, cfg: Dedup) -> DataFrame:
    """Set exact_hash and doc_id of live rows; all but the best of each hash drop as duplicate.

    What the rows' columns cost is computed once, into a written table. The best is a partial
    maximum over its narrow columns; what comes back is joined on the unique position, so a text
    copied a million times is no hot key.
    """
    if not (cfg.enabled and cfg.exact_dedup):
        return df
    hashed = F.sha1(normalised(F.coalesce("text", F.lit(""))).cast("binary"))
    out = df.withColumn("exact_hash", F.when(live(), hashed).otherwise(F.col("exact_hash"))).withColumn("doc_id", F.when(live(), F.col("exact_hash")).otherwise(F.col("doc_id")))
    out = stored(out, "hashed")
    best = out.where(live()).groupBy("exact_hash").agg(F.max_by("input_pos", preference(cfg.keep_policy)).alias("_best")).select(F.col("_best").alias("input_pos"), F.lit(True).alias("_kept"))
    out = out.join(best, "input_pos", "left")
    lost = live() & F.col("_kept").isNull()
    return out.withColumn("drop", F.when(lost, reason("dedup_exact", "duplicate", "equal text")).otherwise(F.col("drop"))).drop("_kept")


@functools.cache
def permutations(num_perm: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the hash family, from SHA-1 of "a0", "a1", ... and "b0", "b1", ..."""

    def value(name: str) -> int:
        return int(hashlib.sha1(name.encode()).hexdigest()[:8], 16)

    return np.array([1 + value(f"a{i}") % (PRIME - 1) for i in range(num_perm)]), np.array([value(f"b{i}") % PRIME for i in range(num_perm)])


def least_values(hashes: np.ndarray, offsets: np.ndarray, num_perm: int) -> np.ndarray:
    """For each document (a run of residues) the least value of each permutation; PRIME everywhere without any."""
    a, b = (v.astype(np.uint64) for v in permutations(num_perm))
    docs, prime, low = len(offsets) - 1, np.uint64(PRIME), np.uint64(31)
    out = np.full((docs, num_perm), prime)
    owner = np.repeat(np.arange(docs), np.diff(offsets))
    for at in range(0, len(hashes), BLOCK):
        x = hashes[at : at + BLOCK, None].astype(np.uint64) * a + b
        # Modulo 2**31 - 1 by folding the upper bits on the lower ones.
        for _ in range(2):
            x = (x & prime) + (x >> low)
        np.subtract(x, prime, out=x, where=x >= prime)
        here = owner[at : at + BLOCK]
        first = np.flatnonzero(np.concatenate(([True], here[1:] != here[:-1])))
        rows = here[first]
        out[rows] = np.minimum(out[rows], np.minimum.reduceat(x, first, axis=0))
    return out.astype(np.int64)


def signatures(docs: DataFrame, shingle_size: int, num_perm: int) -> DataFrame:
    """input_pos and signature (array<long>) of documents with text: shingles and their hashes native, permutations in numpy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(1).value_lengths(), np.int64)
            flat = least_values(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes))), num_perm).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * num_perm, pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["input_pos", "signature"])

    residue = lambda s: F.conv(F.substring(F.sha1(s.cast("binary")), 1, 8), 16, 10).cast("long") % PRIME
    hashed = docs.where(F.coalesce("text", F.lit("")) != "").select("input_pos", F.transform(shingles(F.col("text"), shingle_size), residue).alias("h"))
    return hashed.mapInArrow(run, "input_pos long, signature array<long>")


@functools.cache
def bands(threshold: float, num_perm: int, step: float = 0.001) -> tuple[int, int]:
    """Bands and rows that minimise the mean of false positives and false negatives around the threshold."""

    def candidate(s: np.ndarray, b: int, r: int) -> np.ndarray:
        return 1 - (1 - s**r) ** b

    low, high = np.arange(0, threshold, step) + step / 2, np.arange(threshold, 1, step) + step / 2
    best = None
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            error = 0.5 * candidate(low, b, r).sum() * step + 0.5 * (1 - candidate(high, b, r)).sum() * step
            if best is None or error < best[0]:
                best = (error, b, r)
    return best[1], best[2]


def band_rows(signed: DataFrame, b: int, r: int) -> DataFrame:
    """input_pos, band, bucket."""
    keys = F.array(*[F.xxhash64(F.slice("signature", i * r + 1, r)) for i in range(b)])
    return signed.select("input_pos", F.posexplode(keys).alias("band", "bucket"))


def lsh_links(signed: DataFrame, threshold: float, num_perm: int) -> DataFrame:
    """One link from each row to the first row of every bucket it is in: as many links as rows, not pairs."""
    rows = band_rows(signed, *bands(threshold, num_perm))
    hubs = rows.groupBy("band", "bucket").agg(F.min("input_pos").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(hubs, ["band", "bucket"]).select("a", F.col("input_pos").alias("b")).where("a != b").distinct()


def minhash_dedup(df: DataFrame, cfg: Dedup) -> DataFrame:
    """Clusters of live rows that share a band; all but the best drop as near_duplicate.

    Candidates are not verified and clusters are transitive. The cluster id is the survivor's doc_id.
    """
    if not (cfg.enabled and cfg.minhash):
        return df
    out = df.withColumn("doc_id", F.when(live(), F.coalesce("doc_id", F.sha1(F.coalesce("text", "url").cast("binary")))).otherwise(F.col("doc_id")))
    out = stored(out, "before_minhash")
    links = stored(lsh_links(signatures(out.where(live()), cfg.shingle_size, cfg.num_perm), cfg.jaccard_threshold, cfg.num_perm), "links")
    named = components(links).select(F.col("id").alias("input_pos"), "root")
    members = out.where(live()).join(named, "input_pos").select("root", "input_pos", "doc_id", preference(cfg.keep_policy).alias("rank"))
    best = members.groupBy("root").agg(F.max_by(F.struct("input_pos", "doc_id"), "rank").alias("best"))
    marks = members.join(best, "root").select("input_pos", F.col("best.doc_id").alias("_cluster"), (F.col("best.input_pos") == F.col("input_pos")).alias("_kept"))
    out = out.join(marks, "input_pos", "left")
    lost = live() & F.col("_cluster").isNotNull() & ~F.col("_kept")
    drop = F.when(lost, reason("dedup_minhash", "near_duplicate", F.concat(F.lit("cluster="), F.col("_cluster")))).otherwise(F.col("drop"))
    return out.withColumn("minhash_cluster_id", F.coalesce("_cluster", "minhash_cluster_id")).withColumn("drop", drop).drop("_cluster", "_kept")
