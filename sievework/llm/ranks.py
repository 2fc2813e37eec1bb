"""Exact ranks without a single-task sort: bucket counts, running offsets, ranks inside a bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import free_names


def seeded(seed: int, *columns: str) -> Column:
    """A 60-bit number from the seed and columns, the same in any engine that has MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def seeded_sample(rows: DataFrame, u: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows of least ``u`` (of :func:`seeded`), with a number of candidates that does not grow with the table.

    The numbers are spread evenly over 60 bits, so a cut at half as much again as n rows should
    need leaves a few more than n to be ordered; without it every task would send its n least.
    """
    total = rows.count()
    if total > 2 * n:
        rows = rows.where(F.col(u) < F.lit(int(2**60 * (1.5 * n + 100) / total)))
    return rows.orderBy(u, *ties).limit(n)


def with_rank(df: DataFrame, keys: list[str], bucket: str, order: list[str], out: str = "rank") -> DataFrame:
    """Append the 0-based rank of each row among the rows of its ``keys``, by (bucket, order), and their count as ``<out>_of``.

    Only one row for each (keys, bucket) meets in the offset window; rows themselves are sorted
    inside their bucket, so a key that holds a third of the table is dealt over its buckets.
    """
    counts = df.groupBy(*keys, bucket).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(*[F.col(k).alias(f"_k_{k}") for k in (*keys, bucket)], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias(out + "_of"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in (*keys, bucket)]
    inner = Window.partitionBy(*keys, bucket).orderBy(*order)
    on = same[0]
    for c in same[1:]:
        on = on & c
    ranked = df.withColumn("_in", F.row_number().over(inner) - 1)
    return ranked.join(offsets, on, "inner").withColumn(out, F.col("_before") + F.col("_in")).drop("_in", "_before", *[f"_k_{k}" for k in (*keys, bucket)])


def attach(docs: DataFrame, keys: list[Column], narrow: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """Join columns of ``narrow`` to the rows of ``docs`` with the same keys, one to one.

    Rows whose keys are all equal are interchangeable, so the i-th of them gets the i-th row of
    ``narrow``. The text moves once, by its keys; nothing is broadcast.
    """
    # Names that no column of the rows has, as their own columns stay beside them.
    names_free = free_names([*docs.columns, *columns], *[f"_sw_k{i}" for i in range(len(keys))], *[f"_sw_r{i}" for i in range(len(keys))], "_sw_nl", "_sw_nr", *[f"_sw_c{i}" for i in range(len(columns))])
    tags, others = names_free[: len(keys)], names_free[len(keys) : 2 * len(keys)]
    nl, nr, *values = names_free[2 * len(keys) :]
    left = docs.select("*", *[k.alias(t) for k, t in zip(keys, tags)])
    left = left.withColumn(nl, F.row_number().over(Window.partitionBy(*tags).orderBy(tags[0])))
    right = narrow.select(*[F.col(n).alias(t) for n, t in zip(names, others)], *[F.col(c).alias(v) for c, v in zip(columns, values)])
    right = right.withColumn(nr, F.row_number().over(Window.partitionBy(*others).orderBy(*values)))
    on = F.col(nl) == F.col(nr)
    for t, o in zip(tags, others):
        on = on & F.col(t).eqNullSafe(F.col(o))
    replaced = {c.lower() for c in columns}
    keep = [c for c in docs.columns if c.lower() not in replaced]
    return left.join(right, on, "inner").select(*keep, *[F.col(v).alias(c) for c, v in zip(columns, values)])
