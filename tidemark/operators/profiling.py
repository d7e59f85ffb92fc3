"""Column profiles, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import quantiles


def null_counts(df: DataFrame, table: str | None = None) -> DataFrame:
    """NULLs per column, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in df.columns])
    long = counts.select(F.inline(lines))
    return long if table is None else long.withColumn("table_name", F.lit(table))


def uniqueness(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Distinct values of each column and their share of the rows in percent, in one scan for all columns.

    The exact form counts per column and value first, so neither a frequent value nor a near-unique column strains one task.
    """
    share = F.try_divide(F.col("distinct_values") * 100, F.col("row_count"))
    if approximate:
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.approx_count_distinct(c).alias(c) for c in columns])
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values"), F.col("_rows").alias("row_count")) for c in columns]
        return counts.select(F.inline(F.array(*cells))).withColumn("unique_pct", share)

    def pairs(value: Callable[[str], Column], n: int) -> Column:
        cells = [F.struct(F.lit(c).alias("column_name"), value(c).alias("value"), F.lit(n).alias("n")) for c in columns]
        return F.inline(F.array(*cells))

    nothing = df.sparkSession.range(1).select(pairs(lambda c: F.lit(None).cast("string"), 0))  # a line for columns of no rows
    long = df.select(pairs(lambda c: F.col(c).cast("string"), 1)).unionByName(nothing)
    per_value = long.groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    found = per_value.groupBy("column_name").agg(F.count("value").alias("distinct_values"), F.sum("n").alias("row_count"))
    return found.withColumn("unique_pct", share)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each non-NULL value occurs; sorting is left to the reader of the result."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and interpolated quartiles of the non-NULL values."""
    basics = df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    both = basics.unionByName(quantiles(df, column, (0.25, 0.5, 0.75)), allowMissingColumns=True)
    names = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
    return both.agg(*[F.max(n).alias(n) for n in names]).withColumn("column_name", F.lit(column))


def missing_by_group(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows lacking each of the columns, per group."""
    return df.groupBy(*group).agg(*[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in columns])
