"""Intermediate tables (the library's) and the size of the batches that Python workers get."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from ..plans.shared import drop, release, shared_dir, stored, trim

__all__ = ["drop", "free_names", "release", "shared_dir", "small_batches", "stored", "trim"]

#: Bytes of one Arrow batch handed to a Python worker: bounds a worker's memory whatever the rows' lengths.
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches in bytes (plans read the setting when they run, so it stays)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, each lengthened until no column of the input has it (names ignore case)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
