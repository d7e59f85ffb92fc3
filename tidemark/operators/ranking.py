"""Row numbers and gap sessions that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import shared_root


def numbered(df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """Number the rows 1.. within ``group`` by ``order``.

    Rows are range-partitioned on group and order together, so a group of any size spreads over many tasks. Each
    partition numbers its own rows; the start of a group inside a partition comes from the counts of the partitions
    before it, a table of at most (partitions + groups) rows that Spark broadcasts while it is small.
    """
    spark = df.sparkSession
    shared_root(spark)
    sort = [*group, *order]
    placed = (
        df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in sort])
        .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in sort])
        .withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
        .checkpoint()
    )
    match = [F.col(f"_c.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in group] + [F.col("_c._part") == F.col("_r._part")]
    runs = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    runs = runs.select(*group, "_part", "_first", (_prefix_sum(runs, group)).alias("_before"))
    joined = placed.alias("_r").join(runs.checkpoint().alias("_c"), match, "left")
    return joined.select(
        *[F.col(f"_r.{c}").alias(c) for c in df.columns],
        (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias(name),
    )


def _prefix_sum(runs: DataFrame, group: Sequence[str]) -> Column:
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(w), F.lit(0))


def running_sum(df: DataFrame, order: str, value: str, name: str = "running_sum") -> DataFrame:
    """Sum of ``value`` over all rows up to and including each row by ``order``, which must be unique.

    Same scheme as :func:`numbered`: ranges add up on their own and start from the totals of the ranges before.
    """
    spark = df.sparkSession
    shared_root(spark)
    placed = df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()).checkpoint()
    totals = placed.groupBy("_part").agg(F.sum(value).alias("_n"))
    before = totals.select("_part", _prefix_sum(totals, ()).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_local", F.sum(value).over(inside))
    return local.join(before.checkpoint(), "_part").select(*df.columns, (F.col("_before") + F.col("_local")).alias(name))


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact, linearly interpolated quantiles of a column as one row (p25, p50, ..).

    Values are counted first; the value at a rank is then the smallest one whose running count exceeds it. Nothing
    but one number per rank reaches a single task.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sum(counted, column, "_n", "_upto")
    last = ranked.agg(F.max("_upto")).scalar() - 1
    picks, names = [], []
    placed = ranked.withColumn("_last", last)
    for p in probabilities:
        at = F.lit(float(p)) * F.col("_last")
        low = F.floor(at)
        name = f"p{round(p * 100)}"
        names.append((name, F.col(f"_part_{name}")))
        picks.append(F.min(F.when(F.col("_upto") > low, F.col(column))).alias(f"_low_{name}"))
        picks.append(F.min(F.when(F.col("_upto") > F.least(low + 1, "_last"), F.col(column))).alias(f"_high_{name}"))
        picks.append(F.max(at - low).alias(f"_part_{name}"))
    found = placed.agg(*picks)
    return found.select(
        *[
            (F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * part).alias(n)
            for n, part in names
        ]
    )


def carts(purchases: DataFrame, who: str, at: str, value: str) -> DataFrame:
    """Purchases of one person at most one second apart form one cart.

    Two purchases within the same second always belong together, so rows first reduce to one per person and second.
    Those link up inside an hour (at most 3,600 rows), and hours link up by their outer edges (one row per person and
    hour), so even a person with most of the purchases needs no large window.
    """
    second = F.date_trunc("second", F.col(at)).cast("timestamp_ntz")
    by_second = (
        purchases.filter(F.col(at).isNotNull())
        .groupBy(F.col(who), second.alias("_second"))
        .agg(F.min(at).alias("_first"), F.max(at).alias("_last"), F.count(value).alias("_n"))
        .withColumn("_hour", F.date_trunc("hour", "_second").cast("timestamp_ntz"))
    )
    apart = F.expr("interval 1 second")
    in_hour = Window.partitionBy(who, "_hour").orderBy("_second")
    starts = by_second.withColumn(
        "_starts", F.coalesce(F.col("_first") - F.lag("_last").over(in_hour) > apart, F.lit(False)).cast("int")
    )
    pieces = (
        starts.withColumn("_piece", F.sum("_starts").over(in_hour))
        .groupBy(who, "_hour", "_piece")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
    )
    edges = pieces.groupBy(who, "_hour").agg(
        F.min("_first").alias("_open"), F.max("_last").alias("_close"), F.max("_piece").alias("_breaks")
    )
    by_hour = Window.partitionBy(who).orderBy("_hour")
    joins = F.coalesce(F.col("_open") - F.lag("_close").over(by_hour) <= apart, F.lit(False))
    placed = edges.withColumn("_steps", F.col("_breaks") + F.when(joins, 0).otherwise(1)).select(
        who, "_hour", (F.sum("_steps").over(by_hour) - F.col("_breaks")).alias("_base")
    )
    return (
        pieces.join(placed, [who, "_hour"])
        .groupBy(who, (F.col("_base") + F.col("_piece")).alias("cart_number"))
        .agg(F.min("_first").alias("cart_start"), F.max("_last").alias("cart_end"), F.sum("_n").alias("orders"))
    )
