"""Column profiles of the source entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.entities import ENTITIES
from tidemark.operators import profiling
from tidemark.operators.cdc import union_by_name
from tidemark.registry.base import raw, register
from tidemark.registry.sql import SHORT

_UNIQUE = [
    ("customers", "customer_id"),
    ("customers", "customer_unique_id"),
    ("sellers", "seller_id"),
    ("products", "product_id"),
    ("orders", "order_id"),
    ("order_items", "order_id"),
    ("payments", "order_id"),
    ("reviews", "review_id"),
    ("reviews", "order_id"),
]
_COUNTED = [
    ("customers", "customer_city"),
    ("customers", "customer_state"),
    ("sellers", "seller_city"),
    ("sellers", "seller_state"),
    ("products", "product_category_name"),
    ("orders", "order_status"),
    ("payments", "payment_type"),
]
_DESCRIBED = [("order_items", "freight_value"), ("payments", "payment_value"), ("reviews", "review_score")]


@register(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM raw_{SHORT[e]}"
        for e, spec in ENTITIES.items()
        for c in spec.columns.fieldNames()
    ),
)
def _(spark, sf):
    frames = [(e, raw(spark, sf, e).select(*spec.columns.fieldNames())) for e, spec in ENTITIES.items()]
    return union_by_name(*[profiling.null_counts(df, e) for e, df in frames])


@register(
    "uniqueness",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, "
        f"count(*) AS row_count, count(DISTINCT {c}) * 100 / count(*) AS unique_pct FROM raw_{SHORT[e]}"
        for e, c in _UNIQUE
    ),
)
def _(spark, sf):
    columns: dict[str, list[str]] = {}
    for e, c in _UNIQUE:
        columns.setdefault(e, []).append(c)
    found = [profiling.uniqueness(raw(spark, sf, e), *cs).withColumn("table_name", F.lit(e)) for e, cs in columns.items()]
    return union_by_name(*found)


@register(
    "value_counts",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, '{c}' AS column_name, {c} AS value, count(*) AS occurrences "
        f"FROM raw_{SHORT[e]} WHERE {c} IS NOT NULL GROUP BY {c}"
        for e, c in _COUNTED
    ),
)
def _(spark, sf):
    parts = []
    for e, c in _COUNTED:
        counts = profiling.value_counts(raw(spark, sf, e), c)
        parts.append(
            counts.select(
                F.lit(e).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("value"), "occurrences"
            )
        )
    return union_by_name(*parts)


@register(
    "describe",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50, "
        f"CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM raw_{SHORT[e]}"
        for e, c in _DESCRIBED
    ),
)
def _(spark, sf):
    parts = []
    for e, c in _DESCRIBED:
        stats = profiling.describe(raw(spark, sf, e), c).withColumn("table_name", F.lit(e))
        rounded = {n: F.round(n, 4) for n in ("mean", "std")}
        exact = {n: F.col(n).cast("double") for n in ("min", "p25", "p50", "p75", "max")}
        parts.append(stats.withColumns(rounded | exact))
    return union_by_name(*parts)


@register("null_category_products", "SELECT * FROM raw_products WHERE product_category_name IS NULL")
def _(spark, sf):
    return raw(spark, sf, "products").filter(F.col("product_category_name").isNull())
