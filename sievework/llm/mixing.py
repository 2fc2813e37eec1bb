"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact word length within each source. A source's target first takes
whole copies of the source; what remains of the budget is fitted by lengths: a proportional
share of each length, then a bounded-knapsack dynamic programme over the lengths left for the
exact rest. Documents of each chosen length are picked in seeded order.

The programme covers a rest of 2**14 words at first; where it leaves a gap, less of the share is
held fixed and it covers more, up to the whole budget or 2**24 words. So the words taken come
nearest to the budget from below for every budget of up to 2**24 words, and for a larger one
wherever any of these programmes leaves no gap (as it does where short documents are many). The
reach of the programme is a bitset, kept for about the square root of its steps and made again
between: it takes at most 150 MB, whatever the lengths.

Sources sorted by code point (null last) weigh 5, 2, 1, repeating, and share 100% of all words.
A target stops at ``most`` times its source's words; the excess is shared again by weight. Any
number of sources may be named: their totals stay in a table, and only sums come to the driver.

Defined results: a null text has no words and is taken with none; a null source is a source; a
source without words has target 0; repeated rows are rows like others; an empty table gives no
rows; a very long text is one length more; in ``plan`` input columns are not kept, in ``mix``
they are, whatever their names.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import attach, seeded, with_rank
from .tables import free_names, stored

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
#: Words that the dynamic programme covers, one after another until it leaves no gap.
ROOMS = (1 << 14, 1 << 17, 1 << 20, 1 << 24)


def weighed(sums: DataFrame) -> DataFrame:
    """Sources and their words (source, s) with the weight that their rank by code point gives them."""
    # Buckets in the order of the names: by two characters, null last.
    named = sums.withColumn("_b", F.coalesce(F.concat(F.lit("0"), F.substring("source", 1, 2)), F.lit("1")))
    ranked = with_rank(named, [], "_b", ["source"], "_r")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("_r") % len(WEIGHTS) + 1).cast("int"))
    return ranked.select("source", "s", weight.cast("long").alias("w"))


def targets(sums: DataFrame, most: int) -> DataFrame:
    """source, s and target: all words shared by weight, none above ``most`` times its source's; the excess goes to the others.

    The words for one unit of weight only grow as sources reach their limit, so a few sums over
    the table of sources settle them.
    """
    total = sums.agg(F.sum("s")).first()[0] or 0
    rate, capped = 0.0, -1
    while True:
        over = (F.col("w") * F.lit(rate) > F.col("s") * most) & F.lit(capped >= 0)
        r = sums.where("s > 0").agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("s"))).alias("held"), F.sum(F.when(~over, F.col("w"))).alias("open")).first()
        if r["n"] == capped or not r["open"]:
            break
        rate, capped = (total - most * (r["held"] or 0)) / r["open"], max(r["n"], 0)
    share = F.least(F.col("w") * F.lit(rate), (F.col("s") * most).cast("double"))
    return sums.select("source", "s", F.when(F.col("s") > 0, share).otherwise(F.lit(0.0)).alias("target"))


def _reached(lengths: list[int], counts: list[int], room: int) -> tuple[int, list[int]]:
    """The greatest sum up to ``room`` of at most counts[i] of each lengths[i], and how many of each make it."""
    steps: list[tuple[int, int]] = []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__):
        left, part = min(counts[i], room // lengths[i]), 1
        while left:
            part = min(part, left)
            steps.append((i, part))
            left -= part
            part *= 2
    mask, stride = (1 << room + 1) - 1, max(1, math.isqrt(len(steps)))

    def further(reach: int, step: tuple[int, int]) -> int:
        return reach | reach << lengths[step[0]] * step[1] & mask

    kept, reach, used = [], 1, 0
    for step in steps:
        if reach >> room & 1:
            break
        if used % stride == 0:
            kept.append(reach)
        reach = further(reach, step)
        used += 1
    at = best = room if reach >> room & 1 else reach.bit_length() - 1
    take = [0] * len(lengths)
    for block in range(len(kept) - 1, -1, -1):
        first = block * stride
        # The reach before each step of this stretch, made again from the one that was kept.
        before = [kept.pop()]
        for step in steps[first : min(first + stride, used) - 1]:
            before.append(further(before[-1], step))
        for k in range(len(before) - 1, -1, -1):
            i, part = steps[first + k]
            if not before[k] >> at & 1:
                take[i] += part
                at -= part * lengths[i]
    return best, take


def fit(lengths: list[int], counts: list[int], budget: int, rooms: tuple[int, ...] = ROOMS) -> list[int]:
    """How many documents of each length to take so that their words come nearest to ``budget`` from below."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    if budget <= 0:
        return [0] * len(lengths)
    step = math.gcd(*[n for n, c in zip(lengths, counts) if c])
    best, found = -1, [0] * len(lengths)
    order = sorted(range(len(lengths)), key=lengths.__getitem__)
    for room in rooms:
        take = [c * max(0, budget - room) // total for c in counts]
        rest = budget - sum(n * t for n, t in zip(lengths, take))
        # Beyond the programme's room the longest documents go first.
        for i in reversed(order):
            if rest <= room:
                break
            more = min(counts[i] - take[i], (rest - room) // lengths[i] + 1, rest // lengths[i])
            take[i] += more
            rest -= more * lengths[i]
        got, extra = _reached(lengths, [c - t for c, t in zip(counts, take)], rest)
        if budget - rest + got > best:
            best, found = budget - rest + got, [t + e for t, e in zip(take, extra)]
        if room >= budget or best >= budget // step * step:
            break
    return found


def plan(docs: DataFrame, seed: int = 5, most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Columns doc_id, source, size, source_size, target, copies, taken and text_hash for every row; texts are read once and not moved."""
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
        ),
        "mix_sizes",
    )
    rows = rows.withColumn("_u", seeded(seed, "doc_id")).withColumn("_b", F.shiftright("_u", 52).cast("int"))
    by_length = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix_lengths")
    sums = stored(weighed(by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s"))), "mix_sources")
    goal = targets(sums, most)
    whole = F.when(F.col("s") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("s")))).otherwise(F.lit(0)).cast("long")
    goal = goal.select(F.col("source").alias("_s"), F.col("s").alias("source_size"), "target", whole.alias("_whole"))
    goal = goal.withColumn("_budget", F.when(F.col("_whole") >= most, F.lit(0)).otherwise(F.rint("target").cast("long") - F.col("_whole") * F.col("source_size")).cast("long"))
    lengths = by_length.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    columns = "source string, size long, source_size long, target double, _whole long, _take long"

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        group["_take"] = fit(group["size"].tolist(), group["n"].tolist(), int(group["_budget"].iloc[0]))
        return group[[c.split()[0] for c in columns.split(", ")]]

    # One row for each distinct length of a source: the group is bounded by the longest document.
    fitted = lengths.where("size > 0").groupBy("source").applyInPandas(choose, columns)
    chosen = fitted.unionByName(lengths.where("size = 0").select("source", "size", "source_size", "target", "_whole", F.lit(0).cast("long").alias("_take")))
    chosen = chosen.select(F.col("source").alias("_cs"), F.col("size").alias("_cl"), "source_size", "target", "_whole", "_take")
    ranked = with_rank(rows, ["source", "size"], "_b", ["_u", "doc_id", "text_hash"], "_r")
    out = ranked.join(chosen, F.col("source").eqNullSafe(F.col("_cs")) & (F.col("size") == F.col("_cl")))
    copies = F.when(F.col("size") > 0, F.col("_whole") + (F.col("_r") < F.col("_take")).cast("long")).otherwise(F.lit(1)).cast("int")
    out = out.withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), "text_hash")


def mix(docs: DataFrame, seed: int = 5, most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as the mixture holds them: each as often as it is taken, with its columns unchanged."""
    (copies,) = free_names(docs.columns, "_sw_copies")
    planned = plan(docs, seed, most, id_col, text_col, source_col).withColumnRenamed("copies", copies)
    keys = [F.col(id_col), F.col(source_col), F.xxhash64(F.col(text_col))]
    held = attach(docs, keys, planned, ["doc_id", "source", "text_hash"], [copies])
    return held.where(F.col(copies) > 0).withColumn(copies, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(*docs.columns)
