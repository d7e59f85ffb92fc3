"""The star schema. Every function takes silver rows, a snapshot or a change feed, and returns gold rows.

Rows of a feed keep their ``_change_type``. Merges are keyed on natural keys; the surrogate keys are attributes.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, OP
from tidemark.functions.calendar import calendar_attributes, date_key, date_spine, purchase_bounds
from tidemark.functions.columns import on_day, sequence_key, to_instant
from tidemark.functions.commerce import (
    category_english,
    comment_flags,
    delivery_metrics,
    gmv_item,
    monthly_instalment_value,
)
from tidemark.functions.keys import surrogate_key
from tidemark.operators.cdc import CHANGE_TYPE, PREIMAGE
from tidemark.operators.joins import splittable_join
from tidemark.plans.silver import PROCESSED

GOLD_PROCESSED = "_gold_processed_at"
FEED_COLUMNS = (CHANGE_TYPE, "_commit_version")
#: When the row on the other side of a join was committed; settles which of two versions of a joined row is newer.
PARENT_AT = "_parent_at"


@dataclass(frozen=True)
class GoldTable:
    """Where a gold table comes from, what identifies its rows and how it is laid out for reading."""

    name: str
    source: str
    keys: tuple[str, ...]
    clustered_by: tuple[str, ...]


GOLD: dict[str, GoldTable] = {
    t.name: t
    for t in (
        GoldTable("dim_date", "orders", ("date_actual",), ("date_actual",)),
        GoldTable("dim_customer", "customers", ("customer_id",), ("customer_state",)),
        GoldTable("dim_seller", "sellers", ("seller_id",), ("seller_state",)),
        GoldTable("dim_product", "products", ("product_id",), ("product_category_name_english",)),
        GoldTable("dim_order", "orders", ("order_id",), ("purchase_date_sk", "order_status")),
        GoldTable(
            "fact_order_items", "order_items", ("order_id", "order_item_id"), ("purchase_date_sk", "order_sk")
        ),
        GoldTable(
            "fact_payments", "payments", ("order_id", "payment_sequential"), ("purchase_date_sk", "payment_type")
        ),
        GoldTable("fact_reviews", "reviews", ("review_id", "order_id"), ("purchase_date_sk", "review_score")),
    )
}


def gold_sequence() -> Column:
    return sequence_key(COMMIT_TS, PROCESSED)


def joined_sequence(is_delete: Column) -> Column:
    """Orders the versions of a row joined to a parent: of two equal ones, that with the later parent is the later one."""
    return F.struct(gold_sequence().alias("at"), is_delete.alias("gone"), F.col(PARENT_AT).alias("parent_at"))


def feed_is_delete() -> Column:
    """Deletes follow the change type: a feed's delete row repeats the stored row, whose own operation is I or U."""
    return F.col(CHANGE_TYPE).eqNullSafe("delete")


#: Commit time of placeholders: before every real change, so that the real member takes the place of its placeholder whenever it comes.
BEFORE_ALL = "0001-01-01 00:00:00"
INFERRED, INFERRED_AT, INFERRED_BY = "_is_inferred", "_inferred_at", "_inferred_by"


@dataclass(frozen=True)
class Membership:
    """A dimension whose members ``source`` rows name by ``key``."""

    dim: str
    source: str
    key: str
    dim_key: str


MEMBERSHIPS = (
    Membership("dim_customer", "dim_order", "customer_id", "customer_sk"),
    Membership("dim_seller", "fact_order_items", "seller_id", "seller_sk"),
    Membership("dim_product", "fact_order_items", "product_id", "product_sk"),
)


def placeholders(arrived: DataFrame, member: Membership, batch: str, mode: str = "xxhash64") -> DataFrame:
    """Dimension rows that hold the place of members only known by name: ``arrived`` (key, ``_inferred_at``), one row per key."""
    rows = arrived.select(
        surrogate_key(member.key, mode=mode).alias(member.dim_key),
        member.key,
        F.col(INFERRED_AT).alias(PROCESSED),
        F.col(INFERRED_AT).alias(GOLD_PROCESSED),
        F.lit("I").alias(OP),
        F.lit(BEFORE_ALL).cast("timestamp_ntz").alias(COMMIT_TS),
        F.lit(True).alias(INFERRED),
        INFERRED_AT,
        F.lit(batch).alias(INFERRED_BY),
    )
    return rows.withColumn(PARENT_AT, F.lit(None).cast("timestamp_ntz")) if member.dim == "dim_product" else rows


def _staged(df: DataFrame, columns: list[str | Column], now: datetime | None) -> DataFrame:
    feed = [c for c in (*FEED_COLUMNS, PARENT_AT) if c in df.columns]
    df = df.withColumn(GOLD_PROCESSED, on_day(F.col(PROCESSED), now))
    return df.select(*columns, PROCESSED, GOLD_PROCESSED, OP, COMMIT_TS, *feed)


def _without_preimages(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CHANGE_TYPE) != PREIMAGE) if CHANGE_TYPE in df.columns else df


def dim_date(orders: DataFrame, mode: str = "xxhash64") -> DataFrame:
    attributes = calendar_attributes()
    days = date_spine(purchase_bounds(orders))
    return days.select(date_key("date_actual", mode).alias("date_sk"), "date_actual", *_named(attributes))


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def dim_customer(customers: DataFrame, now: datetime | None = None, mode: str = "xxhash64") -> DataFrame:
    columns = [
        surrogate_key("customer_id", mode=mode).alias("customer_sk"),
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ]
    return _staged(_without_preimages(customers), columns, now)


def dim_seller(sellers: DataFrame, now: datetime | None = None, mode: str = "xxhash64") -> DataFrame:
    columns = [
        surrogate_key("seller_id", mode=mode).alias("seller_sk"),
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ]
    return _staged(_without_preimages(sellers), columns, now)


def join_translation(products: DataFrame, translations: DataFrame) -> DataFrame:
    """Products with the English name of their category, NULL where there is none.

    The translations come from a stored table, so Spark broadcasts them as long as that table is small.
    """
    parent = [PARENT_AT] if PARENT_AT in translations.columns else []
    names = translations.select("product_category_name", "product_category_name_english", *parent)
    return splittable_join(products, names, "product_category_name", "left")


def dim_product(
    products: DataFrame, translations: DataFrame, now: datetime | None = None, mode: str = "xxhash64"
) -> DataFrame:
    columns = [
        surrogate_key("product_id", mode=mode).alias("product_sk"),
        "product_id",
        "product_category_name",
        category_english().alias("product_category_name_english"),
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ]
    return _staged(join_translation(_without_preimages(products), translations), columns, now)


def join_purchase_date(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orders with the calendar key of their purchase day; a day the calendar lacks gives NULL."""
    days = calendar.select(F.col("date_sk").alias("purchase_date_sk"), F.col("date_actual").alias("_day"))
    return orders.join(days, F.col("purchase_date") == F.col("_day"), "left").drop("_day")


def dim_order(
    orders: DataFrame, calendar: DataFrame | None = None, now: datetime | None = None, mode: str = "xxhash64"
) -> DataFrame:
    """Orders with their delivery metrics.

    Without a calendar the key is computed from the purchase day. That equals the join when the calendar is built
    from the same orders, since it then holds every purchase day, and saves reading the orders twice.
    """
    orders = _without_preimages(orders)
    if calendar is None:
        orders = orders.withColumn("purchase_date_sk", date_key("purchase_date", mode))
    else:
        orders = join_purchase_date(orders, calendar)
    instants = to_instant(
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    columns = [
        surrogate_key("order_id", mode=mode).alias("order_sk"),
        surrogate_key("customer_id", mode=mode).alias("customer_sk"),
        "purchase_date_sk",
        "order_id",
        "customer_id",
        "order_status",
        *_named(instants),
        *_named(delivery_metrics()),
    ]
    return _staged(orders, columns, now)


def join_order_keys(rows: DataFrame, orders: DataFrame | None, *keys: str) -> DataFrame:
    """Rows of any fact with keys of their order, NULL where the order is not known, or if no orders are given."""
    if orders is None:
        return rows.withColumns({k: F.lit(None).cast("bigint") for k in keys})
    parent = [PARENT_AT] if PARENT_AT in orders.columns else []
    return splittable_join(rows, orders.select("order_id", *keys, *parent), "order_id", "left")


def fact_order_items(
    items: DataFrame, orders: DataFrame | None, now: datetime | None = None, mode: str = "xxhash64"
) -> DataFrame:
    rows = join_order_keys(_without_preimages(items), orders, "order_sk", "customer_sk", "purchase_date_sk")
    columns = [
        surrogate_key("order_id", "order_item_id", mode=mode).alias("order_item_sk"),
        "order_sk",
        surrogate_key("product_id", mode=mode).alias("product_sk"),
        surrogate_key("seller_id", mode=mode).alias("seller_sk"),
        "customer_sk",
        "purchase_date_sk",
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        gmv_item().alias("gmv_item"),
        *_named(to_instant("shipping_limit_date")),
    ]
    return _staged(rows, columns, now)


def fact_payments(
    payments: DataFrame, orders: DataFrame | None, now: datetime | None = None, mode: str = "xxhash64"
) -> DataFrame:
    rows = join_order_keys(_without_preimages(payments), orders, "order_sk", "purchase_date_sk")
    columns = [
        surrogate_key("order_id", "payment_sequential", mode=mode).alias("payment_sk"),
        "order_sk",
        "purchase_date_sk",
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
        monthly_instalment_value().alias("monthly_instalment_value"),
    ]
    return _staged(rows, columns, now)


def fact_reviews(
    reviews: DataFrame, orders: DataFrame | None, now: datetime | None = None, mode: str = "xxhash64"
) -> DataFrame:
    rows = join_order_keys(_without_preimages(reviews), orders, "order_sk", "purchase_date_sk")
    columns = [
        surrogate_key("review_id", "order_id", mode=mode).alias("review_sk"),
        "order_sk",
        "purchase_date_sk",
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        *_named(to_instant("review_answer_timestamp")),
        *_named(comment_flags()),
    ]
    return _staged(rows, columns, now)


def repair_order_keys(facts: DataFrame, orders: DataFrame) -> DataFrame:
    """Fill the order keys of facts that arrived before their order.

    Only facts without a key take part in the join; the others pass through.
    """
    keys = [k for k in ("order_sk", "customer_sk", "purchase_date_sk") if k in facts.columns]
    settled = facts.filter(F.col("order_sk").isNotNull())
    open_rows = join_order_keys(facts.filter(F.col("order_sk").isNull()).drop(*keys), orders, *keys)
    return settled.unionByName(open_rows.select(*facts.columns))
