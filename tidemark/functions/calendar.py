"""The calendar dimension: a dense run of days and its attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key

SPINE_MONTHS_AHEAD = 12


def purchase_bounds(orders: DataFrame, column: str = "order_purchase_timestamp") -> DataFrame:
    """First and last purchase as one row; it stays on the cluster."""
    return orders.agg(F.min(column).alias("first_purchase"), F.max(column).alias("last_purchase"))


def date_spine(bounds: DataFrame, months_ahead: int = SPINE_MONTHS_AHEAD) -> DataFrame:
    """Every day from the first purchase to ``months_ahead`` months after the last; no rows without bounds.

    There is one row per calendar day, some 37,000 a century, whatever the number of orders.
    """
    start = F.to_date("first_purchase")
    end = F.add_months(F.to_date("last_purchase"), months_ahead)
    return bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date_actual"))


def calendar_attributes(day: str = "date_actual") -> dict[str, Column]:
    d = F.col(day)
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_short": F.date_format(d, "MMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "day_short": F.date_format(d, "EEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
        "fiscal_year": F.year(d),
        "fiscal_quarter": F.quarter(d),
    }


def date_key(day: Column | str, mode: str = "xxhash64") -> Column:
    return surrogate_key(F.col(day).cast("string") if isinstance(day, str) else day.cast("string"), mode=mode)
