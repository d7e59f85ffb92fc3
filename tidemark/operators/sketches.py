"""Quantile and distinct-value sketches that are stored per group and merged upwards, and exact answers that start from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import shared_root

#: Size of a quantile sketch: some 50 kB at most, and exact while a group has fewer values. Its ranks are off by 0.13 % at most in 99 of
#: 100 sketches; three times that is allowed for.
K, RANK_ERROR = 4096, 0.004
#: Values so few that they are all counted; beyond, neighbouring ranks are less than ``1 / FEW`` apart.
FEW = 1000
#: Binary logarithm of the entries of a distinct sketch: an error of some 0.8 % (HLL) and 1.6 % (theta) in one standard deviation.
DISTINCT_SIZE = 14


def _number(column: str) -> Column:
    """A column as a double; what is no number (NaN) is left out like NULL."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One narrow row per value: the group, the column's name and its value."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), _number(c).alias("value")) for c in columns])
    return df.select(*by, F.inline(entries)).filter("value is not null")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``by, column, probability, quantile``: exact, linearly interpolated quantiles of many columns in two scans and no sort of the data.

    The first scan makes a sketch of every column, which brackets each wanted rank. The second counts the values below a bracket
    and lists the distinct ones inside, a share of the values as small as the error of the sketch; the quantile is picked among these by
    their running counts. Brackets are verified by the counts; one that misses its rank, which a sketch allows with small
    probability, is widened to all values. Groups without values, and values of a group that is NULL, have no row.
    """
    shared_root(df.sparkSession)
    values, key = _long(df, columns, by), [*by, "column"]
    first = values.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("s"), F.min("value").alias("least"), F.max("value").alias("most"))

    def bracket(p: float) -> Column:
        a, b = (F.kll_sketch_get_quantile_double("s", F.lit(min(max(r, 0.0), 1.0))) for r in (p - RANK_ERROR - 2 / FEW, p + RANK_ERROR + 2 / FEW))
        few = F.col("n") <= FEW
        return F.struct(F.lit(float(p)).alias("probability"), F.when(few, F.col("least")).otherwise(a).alias("a"), F.when(few, F.col("most")).otherwise(b).alias("b"))

    wanted = first.select(*key, "n", "least", "most", F.inline(F.array(*[bracket(p) for p in probabilities])))
    at = F.col("probability") * (F.col("n") - 1)
    wanted = wanted.withColumns({"low": F.floor(at), "high": F.ceil(at)}).checkpoint()
    found = _picked(values, wanted, key, by).checkpoint()
    missed = wanted.join(found.select(*key, "probability"), [*key, "probability"], "left_anti")
    missed = missed.withColumns({"a": F.col("least"), "b": F.col("most")}).checkpoint()
    return found if missed.isEmpty() else found.unionByName(_picked(values, missed, key, by))


def _picked(values: DataFrame, wanted: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The quantiles whose ranks lie inside their brackets ``a`` to ``b``.

    Without groups there is one bracket per column and probability; these go to the values, as a join by shuffle would bring all values
    of a column to one task.
    """
    slot = [*key, "probability"]
    brackets = wanted.select(*key, "probability", "low", "high", "n", "a", "b")
    near = values.join(brackets if by else F.broadcast(brackets), list(key)).filter(F.col("value") <= F.col("b"))
    value = F.when(F.col("value") >= F.col("a"), F.col("value"))  # NULL stands for all values below the bracket
    counted = near.groupBy(*slot, "low", "high", "n", value.alias("value")).agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy(*slot).orderBy(F.col("value").asc_nulls_first()))
    ranked = counted.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("times"))

    def of(rank: str) -> Column:
        return F.max(F.when((F.col("from") <= F.col(rank)) & (F.col(rank) < F.col("upto")), F.col("value"))).alias(f"at_{rank}")

    picked = ranked.groupBy(*slot, "low", "high", "n").agg(of("low"), of("high")).dropna(subset=["at_low", "at_high"])
    share = F.col("probability") * (F.col("n") - 1) - F.col("low")
    return picked.select(*slot, (F.col("at_low") + (F.col("at_high") - F.col("at_low")) * share).alias("quantile"))


# -- distributions by day -----------------------------------------------------------------------------------------


def daily_profile(df: DataFrame, day: str, column: str, k: int = K) -> DataFrame:
    """``day, rows, nulls, sketch, distinct``: what a run stores of a column for each day; profiles of a day add up by :func:`merged`."""
    value = _number(column)
    return df.filter(F.col(day).isNotNull()).groupBy(F.col(day).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"),
        F.hll_sketch_agg(value.cast("string"), DISTINCT_SIZE).alias("distinct"),
    )


def merged(profiles: DataFrame, *by: str | Column) -> DataFrame:
    """Profiles of one group as one."""
    return profiles.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.kll_merge_agg_double("sketch").alias("sketch"), F.hll_union_agg("distinct").alias("distinct")
    )


def _median_between(profile: DataFrame, name: str) -> dict[str, Column]:
    """Two values that enclose the lower median of a profile."""
    n = F.col("rows") - F.col("nulls")

    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(rank, 0.0), 1.0)))

    def edge(rank: float) -> Column:
        return F.when(n > K // 2, at(rank)).when(n > 0, at(0.5))

    return {f"{name}_from": edge(0.5 - RANK_ERROR), f"{name}_to": edge(0.5 + RANK_ERROR)}


def drifting_days(df: DataFrame, profiles: DataFrame, day: str, column: str, days: int = 7, median_band: float = 0.25, null_band: float = 0.1) -> DataFrame:
    """``day, median_drifts, nulls_drift``: whether a day's lower median, or share of NULLs, leaves the band around that of the ``days`` before it.

    A median drifts if it is over ``1 + median_band`` times, or under ``1 - median_band`` times, the median of all values of the preceding calendar
    days; a share of NULLs if it differs by over ``null_band``. Days without values, or with none before them, drift in no median;
    days without rows before them, in no share. Stored ``profiles`` decide all days whose sketches leave no doubt; the others, close to the edge
    of the band, are counted in ``df`` itself. So the verdict is exact, and ``df`` is read for doubtful days only.
    """
    shared_root(df.sparkSession)
    own = merged(profiles, "day")
    later = F.explode(F.sequence(F.lit(1), F.lit(days)))
    moved = profiles.select("*", later.alias("_by")).withColumn("day", F.date_add("day", F.col("_by"))).drop("_by")
    before = merged(moved, "day")
    own = own.select("day", "rows", "nulls", *[c.alias(n) for n, c in _median_between(own, "m").items()])
    before = before.select("day", F.col("rows").alias("r"), F.col("nulls").alias("z"), *[c.alias(n) for n, c in _median_between(before, "p").items()])
    both = own.join(before, "day", "left").checkpoint()
    high, low = 1 + median_band, 1 - median_band

    def drift(m: str, p: str) -> Column:
        return F.coalesce((F.col(m) > F.col(p) * high) | (F.col(m) < F.col(p) * low), F.lit(False))

    corners = [drift(m, p) for m in ("m_from", "m_to") for p in ("p_from", "p_to")]
    # Between the corners the verdict may only change if a corner differs, or if the corners leave the band on both sides.
    sure = reduce(lambda a, b: a & b, [c == corners[0] for c in corners[1:]])
    sure = sure & ~(corners[0] & (F.col("m_from") < F.col("p_to") * low) & (F.col("m_to") > F.col("p_from") * high))
    judged = both.withColumns({"sure": sure, "median_drifts": corners[0]})
    doubtful = judged.filter(~F.col("sure")).select("day").checkpoint()
    settled = _median_drifts(df, doubtful, day, column, days, high, low)
    judged = judged.join(settled.withColumnRenamed("median_drifts", "_exact"), "day", "left")
    nulls = F.abs(F.try_divide("nulls", "rows") - F.try_divide("z", "r")) > null_band
    return judged.select("day", F.coalesce("_exact", "median_drifts").alias("median_drifts"), F.coalesce(nulls, F.lit(False)).alias("nulls_drift"))


def _median_drifts(df: DataFrame, doubtful: DataFrame, day: str, column: str, days: int, high: float, low: float) -> DataFrame:
    """The verdict of doubtful days from their values: counts per value, ranked inside each day and its preceding days."""
    values = df.select(F.col(day).cast("date").alias("_d"), _number(column).alias("v")).filter("_d is not null and v is not null")
    counted = values.groupBy("_d", "v").agg(F.count(F.lit(1)).alias("n"))
    needed = doubtful.select("day", F.explode(F.sequence(F.lit(0), F.lit(days))).alias("back")).select("day", F.date_sub("day", F.col("back")).alias("_d"), (F.col("back") == 0).alias("own"))
    rows = counted.join(needed, "_d").groupBy("day", "own", "v").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("day", "own").orderBy("v"))
    total = F.sum("n").over(Window.partitionBy("day", "own"))
    ranked = rows.withColumns({"upto": upto, "total": total}).filter(F.col("upto") >= F.ceil(F.col("total") / 2))
    medians = ranked.groupBy("day").agg(F.min(F.when(F.col("own"), F.col("v"))).alias("m"), F.min(F.when(~F.col("own"), F.col("v"))).alias("p"))
    drifts = (F.col("m") > F.col("p") * high) | (F.col("m") < F.col("p") * low)
    return medians.select("day", F.coalesce(drifts, F.lit(False)).alias("median_drifts"))


# -- distinct values ----------------------------------------------------------------------------------------------


def distinct_sketches(df: DataFrame, grain: Sequence[str], columns: Mapping[str, str], size: int = DISTINCT_SIZE) -> DataFrame:
    """A theta sketch of every column (result name -> column) for each group of the finest grain that questions are asked at."""
    return df.groupBy(*grain).agg(*[F.theta_sketch_agg(F.col(c).cast("string"), size).alias(n) for n, c in columns.items()])


def distinct_estimates(sketches: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct values per coarser group out of stored sketches; the rows they were made of are not read."""
    united = sketches.groupBy(*by).agg(*[F.theta_union_agg(n).alias(n) for n in names])
    return united.select(*by, *[F.theta_sketch_estimate(n).alias(n) for n in names])


def shared_estimate(sketches: DataFrame, name: str, first: Column, second: Column) -> DataFrame:
    """How many values occur both in the groups of ``first`` and in those of ``second``, as one row ``shared``."""
    either = sketches.filter(first | second)
    parts = either.agg(F.theta_union_agg(F.when(first, F.col(name))).alias("a"), F.theta_union_agg(F.when(second, F.col(name))).alias("b"))
    return parts.select(F.coalesce(F.theta_sketch_estimate(F.theta_intersection("a", "b")), F.lit(0)).alias("shared"))
