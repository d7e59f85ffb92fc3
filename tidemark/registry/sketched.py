"""Exact quantiles from sketches, days whose distribution drifts, and distinct counts out of stored sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS
from tidemark.operators.sketches import daily_profile, distinct_estimates, distinct_sketches, drifting_days, exact_quantiles, shared_estimate
from tidemark.registry.base import raw, register
from tidemark.registry.workspace import early, late, once, stored_star
from tidemark.session import scratch

PROBABILITIES = (0.01, 0.25, 0.5, 0.75, 0.99)
NUMBERS = {
    "order_items": ("order_item_id", "price", "freight_value"),
    "products": (
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
}


@register(
    "exact_quantiles",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {p}::DOUBLE AS probability, quantile_cont({c}::DOUBLE, {p}) AS quantile
            FROM {source}"""
        for t, source in (("order_items", "raw_items"), ("products", "raw_products"))
        for c in NUMBERS[t]
        for p in PROBABILITIES
    ),
)
def _(spark, sf):
    """Five quantiles of all numeric columns of two tables, two scans each."""
    parts = []
    for name, columns in NUMBERS.items():
        found = exact_quantiles(raw(spark, sf, name), columns, PROBABILITIES)
        parts.append(found.select(F.lit(name).alias("table_name"), F.col("column").alias("column_name"), "probability", "quantile"))
    return parts[0].unionByName(parts[1])


MEDIAN_BAND, NULL_BAND, DAYS = 0.25, 0.1, 7


@register(
    "drifting_days",
    f"""WITH v AS (SELECT CAST("{COMMIT_TS}" AS DATE) AS day, CASE WHEN price >= 20000 THEN price END AS price FROM raw_items),
        own AS (SELECT day, quantile_disc(price, 0.5) AS m, count(*) AS n, count(*) - count(price) AS z FROM v GROUP BY day),
        before AS (SELECT own.day, quantile_disc(v.price, 0.5) AS p, count(*) AS r, count(*) - count(v.price) AS y
                   FROM own JOIN v ON v.day BETWEEN own.day - {DAYS} AND own.day - 1 GROUP BY own.day)
        SELECT day, coalesce(m > p * {1 + MEDIAN_BAND} OR m < p * {1 - MEDIAN_BAND}, false) AS median_drifts,
               coalesce(abs(z / n - y / r) > {NULL_BAND}, false) AS nulls_drift
        FROM own LEFT JOIN before USING (day)""",
)
def _(spark, sf):
    """Days on which the median of the higher prices, or the share of lower ones, leaves the band of the week before.

    Profiles are stored in two parts, as two runs would, and add up.
    """
    items = raw(spark, sf, "order_items").select(COMMIT_TS, F.when(F.col("price") >= 20000, F.col("price")).alias("price"))
    root = scratch(spark, "profiles")
    for k, part in enumerate((early(items), late(items))):
        daily_profile(part, COMMIT_TS, "price").write.parquet(f"{root}/batch={k}")
    profiles = spark.read.parquet(root).drop("batch")
    return drifting_days(items, profiles, COMMIT_TS, "price", DAYS, MEDIAN_BAND, NULL_BAND)


SOLD = ("dim_date", "fact_order_items")


def sketches(spark, sf):
    """Orders, sellers and products sold, sketched by month, day of the week and state of the seller."""

    def build(root):
        star = stored_star(spark, sf, SOLD)
        days = star["dim_date"].select(F.col("date_sk").alias("_day"), "year", "year_month", "is_weekend")
        rows = star["fact_order_items"].join(days, F.col("purchase_date_sk") == F.col("_day"))
        distinct_sketches(rows, ("year", "year_month", "is_weekend"), COUNTED).write.parquet(root)
        return root

    return spark.read.parquet(once(spark, sf, "sketches", build))


COUNTED = {"orders": "order_id", "sellers": "seller_id", "products": "product_id"}
LEVELS = {"year": ("year",), "year_month": ("year_month",), "weekend": ("is_weekend",), "all": ()}
CLOSE = 0.05  # over three standard deviations of a sketch of this size


def _member(by):
    return F.concat_ws("/", *[F.col(c).cast("string") for c in by]) if by else F.lit("all")


def exact_counts(rows):
    """``level, member`` and the distinct values of each kind, for all levels at once.

    Values are made distinct at the finest grain, then meet by kind and value; there each is made distinct for every member it occurs
    in, so only counts travel on. A value that fills the table is a few rows by then.
    """
    values = F.array(*[F.struct(F.lit(n).alias("of"), F.col(c).cast("string").alias("value")) for n, c in COUNTED.items()])
    levels = F.array(*[F.struct(F.lit(level).alias("level"), _member(by).alias("member")) for level, by in LEVELS.items()])
    grain = ["year", "year_month", "is_weekend"]
    met = rows.select(*grain, F.inline(values)).distinct().repartition("of", "value")
    once_each = met.select("of", "value", F.inline(levels)).distinct().filter("value is not null")
    return once_each.groupBy("level", "member").agg(*[F.count_if(F.col("of") == n).alias(n) for n in COUNTED])


def _exact(level, by):
    named = " || '/' || ".join(f"CAST({c} AS VARCHAR)" for c in by) or "'all'"
    values = ", ".join(f"count(DISTINCT {c}) AS {n}" for n, c in COUNTED.items())
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT '{level}' AS level, {named} AS member, {values} FROM fact_order_items JOIN dim_date ON purchase_date_sk = date_sk {group}"


@register(
    "distinct_from_sketches",
    f"""SELECT level, member, {', '.join(f'{n} AS {n}, true AS {n}_close' for n in COUNTED)}
        FROM ({' UNION ALL '.join(_exact(level, by) for level, by in LEVELS.items())})""",
)
def _(spark, sf):
    """Distinct counts at four levels: exact, and whether the estimate out of the stored sketches is close."""
    star, parts = stored_star(spark, sf, SOLD), []
    days = star["dim_date"].select(F.col("date_sk").alias("_day"), "year", "year_month", "is_weekend")
    rows = star["fact_order_items"].join(days, F.col("purchase_date_sk") == F.col("_day"))
    exact = exact_counts(rows)
    for level, by in LEVELS.items():
        label = [F.lit(level).alias("level"), _member(by).alias("member")]
        told = distinct_estimates(sketches(spark, sf), list(COUNTED), by).select(*label, *[F.col(n).alias(f"_{n}") for n in COUNTED])
        parts.append(told)
    told = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    close = [(F.abs(F.col(f"_{n}") - F.col(n)) <= CLOSE * F.col(n)).alias(f"{n}_close") for n in COUNTED]
    return told.join(exact, ["level", "member"], "left").na.fill(0, list(COUNTED)).select("level", "member", *COUNTED, *close)


@register(
    "shared_from_sketches",
    """SELECT count(*) AS shared, true AS close FROM (
         SELECT product_id FROM fact_order_items JOIN dim_date ON purchase_date_sk = date_sk WHERE is_weekend
         INTERSECT SELECT product_id FROM fact_order_items JOIN dim_date ON purchase_date_sk = date_sk WHERE NOT is_weekend)""",
)
def _(spark, sf):
    """Products sold both at weekends and on working days: exact, and whether the intersection of sketches is close."""
    star = stored_star(spark, sf, SOLD)
    days = star["dim_date"].select(F.col("date_sk").alias("_day"), "is_weekend")
    sold = star["fact_order_items"].join(days, F.col("purchase_date_sk") == F.col("_day")).select("product_id", "is_weekend")
    exact = sold.groupBy("product_id").agg(F.max("is_weekend").alias("a"), F.min("is_weekend").alias("b"))
    exact = exact.agg(F.count_if(F.col("a") & ~F.col("b")).alias("shared"), F.lit(1).alias("one"))
    told = shared_estimate(sketches(spark, sf), "products", F.col("is_weekend"), ~F.col("is_weekend")).select(F.col("shared").alias("told"), F.lit(1).alias("one"))
    return exact.join(told, "one").select("shared", (F.abs(F.col("told") - F.col("shared")) <= CLOSE * F.col("shared")).alias("close"))
