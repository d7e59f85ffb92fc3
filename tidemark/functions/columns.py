"""Whole-frame column operators. Each is one projection, so plans stay flat."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_CATEGORY = "sem categoria"  # fixed value


def trim_all_strings(df: DataFrame) -> DataFrame:
    """Trim every string column; an all-blank value becomes '' and stays non-NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(F.col(c)) for c in strings})


def cast_columns(df: DataFrame, casts: Mapping[str, str], flag: str | None = None) -> DataFrame:
    """Cast the listed columns that exist; values that do not parse become NULL.

    A ``string`` target is also lower-cased. With ``flag`` the frame gains a column holding the name of the first
    column whose non-NULL value failed to parse.
    """
    present = {c: t for c, t in casts.items() if c in df.columns}
    converted = {}
    for name, target in present.items():
        value = F.col(name).try_cast(target)
        converted[name] = F.lower(value) if target == "string" else value
    if flag is not None:
        bad = [
            F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in present.items()
        ]
        converted[flag] = F.coalesce(*bad) if bad else F.lit(None).cast("string")
    return df.withColumns(converted) if converted else df


def default_category(df: DataFrame, column: str = "product_category_name", label: str = MISSING_CATEGORY) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(label)))


def correct_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_purchase_date(df: DataFrame) -> DataFrame:
    """Add the purchase day, unless the source already delivers it."""
    if "purchase_date" in df.columns:
        return df
    return df.withColumn("purchase_date", F.to_date("order_purchase_timestamp"))


def on_day(day: Column, now: datetime | Column | None = None) -> Column:
    """The clock time of ``now`` moved to the day of ``day``, as a zone-less timestamp.

    ``now`` defaults to the current time; pass a datetime to make a run repeatable.
    """
    if isinstance(now, datetime):
        hour, minute, second = F.lit(now.hour), F.lit(now.minute), F.lit(now.second)
    else:
        moment = F.current_timestamp() if now is None else now
        hour, minute, second = F.hour(moment), F.minute(moment), F.second(moment)
    clock = F.make_dt_interval(F.lit(0), hour, minute, second.cast("decimal(18,6)"))
    return F.to_date(day).cast("timestamp_ntz") + clock


def sequence_key(commit: str, fallback: str) -> Column:
    """What orders the versions of a row: its commit time, else the time it was received."""
    return F.coalesce(F.col(commit), F.col(fallback))


def to_instant(*names: str) -> dict[str, Column]:
    """Zone-less timestamps as instants (in the session time zone), for reporting tools."""
    return {n: F.col(n).cast("timestamp") for n in names}


def money(column: Column | str) -> Column:
    """The sum of an amount at full precision, rounded to cents only at the end."""
    return F.round(F.sum(column), 2)
