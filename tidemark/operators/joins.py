"""Joins for keys of very uneven weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` that adaptive execution can split when one key holds much of ``left``.

    Spark splits a skewed partition only where both sides are shuffled for the join itself, not where one side still
    has the partitioning of an earlier step, as a table fresh from :func:`scd1_apply` has. The hash as a second key
    asks for that shuffle; the pairs that match stay the same. Small sides are broadcast as ever.
    """
    twin = f"_{key}_right"
    moved = right.withColumnRenamed(key, twin)
    matches = (F.col(key) == F.col(twin)) & (F.xxhash64(key) == F.xxhash64(twin))
    joined = left.join(moved, matches, how)
    if how in ("right", "right_outer"):
        return joined.withColumn(key, F.col(twin)).drop(twin)
    return joined.drop(twin)
