"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import drop, release, stored


def components(edges: DataFrame) -> DataFrame:
    """id and root (the least id it is connected with) of every id in ``edges`` (a, b).

    Alternating large-star and small-star steps: each links neighbours straight to the least one
    seen, so long chains fold in a logarithmic number of rounds. Rounds are written tables, and
    only a flag comes to the driver.
    """
    now = stored(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: neighbours above a vertex go to the least of its neighbourhood.
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("c")).select("v", F.col("m").alias("u")).where("u < v").distinct()
        # Small star: neighbours below a vertex, and itself, go to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("c"), "m")
        joined = large.join(low, F.col("v") == F.col("c"))
        small = joined.select(F.col("m").alias("u"), F.col("u").alias("v")).unionByName(joined.select(F.col("m").alias("u"), "v")).where("u < v").distinct()
        after = stored(small, "edges")
        drop(now)
        now = after
        # Settled when every vertex hangs on one root that hangs on nothing.
        ends = now.select(F.col("v").alias("w"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(now.select(F.col("u").alias("w"), F.lit(0).alias("up"), F.lit(1).alias("root")))
        if ends.groupBy("w").agg(F.sum("up").alias("up"), F.max("root").alias("root")).where("up > 1 or (up > 0 and root = 1)").isEmpty():
            release(now.sparkSession)
            return now.select(F.col("v").alias("id"), F.col("u").alias("root")).unionByName(now.select(F.col("u").alias("id"), F.col("u").alias("root")).distinct())
