"""Joins that resolve keys, and the eight tables of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.cdc import inferred_members
from tidemark.plans import analyses, star
from tidemark.registry.base import KEY_MODE, cleaned, current, gold, prepared, register

for _name in star.GOLD:

    @register(_name, f"SELECT * FROM {_name}")
    def _(spark, sf, name=_name):
        return gold(spark, sf)[name]


@register(
    "join_translation",
    """SELECT product_id, p.product_category_name, product_category_name_english FROM prep_products p
       LEFT JOIN (SELECT product_category_name, product_category_name_english FROM silver_translation) t
       ON p.product_category_name = t.product_category_name""",
)
def _(spark, sf):
    names = current(spark, sf, "product_category_name_translation")
    products = prepared(spark, sf, "products").select("product_id", "product_category_name")
    return star.join_translation(products, names)


@register(
    "join_purchase_date_sk",
    """SELECT order_id, purchase_date, date_sk AS purchase_date_sk
       FROM prep_orders LEFT JOIN dim_date ON purchase_date = date_actual""",
)
def _(spark, sf):
    days = star.dim_date(current(spark, sf, "orders"), KEY_MODE)
    return star.join_purchase_date(prepared(spark, sf, "orders").select("order_id", "purchase_date"), days)


def _order_keys(name, entity, short, row_key, keys):
    columns = ", ".join(f"i.{k}" for k in row_key)
    sql = f"""SELECT {columns}, {', '.join(keys)} FROM clean_{short} i
              LEFT JOIN (SELECT order_id, {', '.join(keys)} FROM dim_order) o ON i.order_id = o.order_id"""

    @register(name, sql)
    def _(spark, sf):
        orders = star.dim_order(current(spark, sf, "orders"), None, None, KEY_MODE)
        return star.join_order_keys(cleaned(spark, sf, entity).select(*row_key), orders, *keys)


_order_keys(
    "join_items_to_order",
    "order_items",
    "items",
    ["order_id", "order_item_id", "AR_H_COMMIT_TIMESTAMP"],
    ["order_sk", "customer_sk", "purchase_date_sk"],
)
_order_keys(
    "join_payments_to_order", "payments", "payments", ["order_id", "payment_sequential"], ["order_sk", "purchase_date_sk"]
)
_order_keys("join_reviews_to_order", "reviews", "reviews", ["review_id", "order_id"], ["order_sk", "purchase_date_sk"])


@register(
    "star_join",
    """SELECT order_item_sk, gmv_item, year_month, customer_state, product_category_name_english, seller_state,
              order_status
       FROM fact_order_items f
       JOIN dim_customer c ON f.customer_sk = c.customer_sk JOIN dim_seller s ON f.seller_sk = s.seller_sk
       JOIN dim_date d ON f.purchase_date_sk = d.date_sk JOIN dim_order o ON f.order_sk = o.order_sk
       LEFT JOIN dim_product p ON f.product_sk = p.product_sk""",
)
def _(spark, sf):
    wide = analyses.star_rows(
        gold(spark, sf),
        "fact_order_items",
        {
            "dim_customer": ("customer_state",),
            "dim_product": ("product_category_name_english",),
            "dim_seller": ("seller_state",),
            "dim_date": ("year_month",),
            "dim_order": ("order_status",),
        },
    )
    return wide.select(
        "order_item_sk",
        "gmv_item",
        "year_month",
        "customer_state",
        "product_category_name_english",
        "seller_state",
        "order_status",
    )


@register(
    "payments_reviews_star",
    """SELECT 'fact_payments' AS fact, payment_sk AS row_sk, payment_value AS measure, order_status, year_month
       FROM fact_payments f JOIN dim_order o ON f.order_sk = o.order_sk JOIN dim_date d ON f.purchase_date_sk = d.date_sk
       UNION ALL
       SELECT 'fact_reviews', review_sk, CAST(review_score AS DOUBLE), order_status, year_month
       FROM fact_reviews f JOIN dim_order o ON f.order_sk = o.order_sk JOIN dim_date d ON f.purchase_date_sk = d.date_sk""",
)
def _(spark, sf):
    tables = gold(spark, sf)
    wanted = {"dim_order": ("order_status",), "dim_date": ("year_month",)}

    def side(fact, key, value):
        rows = analyses.star_rows(tables, fact, wanted)
        value = F.col(value).cast("double").alias("measure")
        return rows.select(F.lit(fact).alias("fact"), F.col(key).alias("row_sk"), value, "order_status", "year_month")

    return side("fact_payments", "payment_sk", "payment_value").unionByName(
        side("fact_reviews", "review_sk", "review_score")
    )


@register(
    "funnel_join",
    """SELECT o.order_id, order_status, order_item_id, price, freight_value
       FROM silver_orders o LEFT JOIN silver_items i ON o.order_id = i.order_id""",
)
def _(spark, sf):
    return analyses.funnel(current(spark, sf, "orders"), current(spark, sf, "order_items"))


@register(
    "revenue_join",
    """SELECT o.order_id, order_status, purchase_date, order_item_id, price, freight_value
       FROM silver_orders o JOIN silver_items i ON o.order_id = i.order_id""",
)
def _(spark, sf):
    return analyses.revenue_rows(current(spark, sf, "orders"), current(spark, sf, "order_items"))


def _absent(name, entity, short):
    @register(
        name,
        f"SELECT order_id, order_status FROM silver_orders WHERE order_id NOT IN (SELECT order_id FROM silver_{short})",
    )
    def _(spark, sf):
        orders = current(spark, sf, "orders").select("order_id", "order_status")
        return analyses.orders_without(orders, current(spark, sf, entity))

    @register(
        f"{name}_rate",
        f"""SELECT count(*) AS orders, count(*) FILTER (WHERE k IS NULL) AS missing,
                   count(*) FILTER (WHERE k IS NULL) / count(*) AS missing_rate
            FROM silver_orders o LEFT JOIN (SELECT DISTINCT order_id AS k FROM silver_{short}) ON order_id = k""",
    )
    def _(spark, sf):
        return analyses.missing_rate(current(spark, sf, "orders"), current(spark, sf, entity))


_absent("ghost_orders", "order_items", "items")
_absent("unpaid_orders", "payments", "payments")


@register(
    "inferred_members",
    """SELECT order_id, order_status, customer_id, false AS _is_inferred FROM silver_orders
       UNION ALL SELECT DISTINCT order_id, 'unknown', NULL, true FROM silver_items
       WHERE order_id NOT IN (SELECT order_id FROM silver_orders)""",
)
def _(spark, sf):
    orders = current(spark, sf, "orders").select("order_id", "order_status", "customer_id")
    return inferred_members(
        current(spark, sf, "order_items"), orders, "order_id", {"order_status": F.lit("unknown")}
    )
