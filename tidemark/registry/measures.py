"""Measures, dashboard visuals and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import analyses
from tidemark.plans.medallion import FACTS
from tidemark.plans.metrics import measure
from tidemark.registry.base import current, gold, prepared, register
from tidemark.registry.sql import money
from tidemark.registry.workspace import stored_star

GMV = money("gmv_item")
ON_TIME = "count(*) FILTER (WHERE is_on_time) / nullif(count(*) FILTER (WHERE is_delivered), 0)"

# Every measure over its own table, and the join a grouping attribute adds.
_TOTALS = {
    "total_gmv": ("fact_order_items", GMV),
    "total_orders": ("fact_order_items", "count(DISTINCT order_id)"),
    "total_customers": ("dim_customer", "count(DISTINCT customer_unique_id)"),
    "aov": ("fact_order_items", f"{GMV} / count(DISTINCT order_id)"),
    "csat": ("fact_reviews", "avg(review_score)"),
    "on_time_pct": ("dim_order", ON_TIME),
    "total_payment_value": ("fact_payments", money("payment_value")),
    "seller_count": ("fact_order_items", "count(DISTINCT seller_id)"),
}


def _total(name):
    table, value = _TOTALS[name]

    @register(name, f"SELECT {value} AS {name} FROM {table}")
    def _(spark, sf):
        return measure(gold(spark, sf), [name])


for _name in _TOTALS:
    _total(_name)


def _scalars(names, conditions=None):
    parts = []
    for n in names:
        table, value = _TOTALS[n]
        where = (conditions or {}).get(table, "")
        parts.append(f"(SELECT {value} FROM {table} {where}) AS {n}")
    return "SELECT " + ", ".join(parts)


CARDS_SQL = _scalars(analyses.KPIS)
MONTHLY_SQL = f"""
    SELECT year_month, {GMV} AS total_gmv, count(DISTINCT order_id) AS total_orders
    FROM fact_order_items JOIN dim_date ON purchase_date_sk = date_sk GROUP BY year_month ORDER BY year_month"""


@register("kpi_cards", CARDS_SQL)
def _(spark, sf):
    return analyses.kpi_cards(gold(spark, sf))


@register("monthly_gmv_orders", MONTHLY_SQL)
def _(spark, sf):
    return analyses.monthly_gmv_orders(gold(spark, sf))


@register(
    "payment_mix",
    f"""SELECT payment_type, {money('payment_value')} AS total_payment_value,
               {money('payment_value')} * 100
                 / (SELECT {money('payment_value')} FROM fact_payments) AS pct_of_total
        FROM fact_payments GROUP BY payment_type""",
)
def _(spark, sf):
    return analyses.payment_mix(gold(spark, sf))


DRILL_ACROSS = """
    SELECT coalesce(a.delivery_days, b.delivery_days) AS delivery_days, csat, total_orders
    FROM (SELECT delivery_days, avg(review_score) AS csat FROM fact_reviews r JOIN dim_order o ON r.order_sk = o.order_sk
          GROUP BY delivery_days) a
    FULL JOIN (SELECT delivery_days, count(DISTINCT f.order_id) AS total_orders
               FROM fact_order_items f JOIN dim_order o ON f.order_sk = o.order_sk GROUP BY delivery_days) b
    ON a.delivery_days IS NOT DISTINCT FROM b.delivery_days"""


@register("delivery_vs_review", DRILL_ACROSS)
def _(spark, sf):
    return analyses.delivery_vs_review(stored_star(spark, sf))


@register(
    "drill_across",
    f"""SELECT year_month, max(total_gmv) AS total_gmv, max(total_payment_value) AS total_payment_value,
               max(csat) AS csat
        FROM (SELECT year_month, {GMV} AS total_gmv, NULL AS total_payment_value, NULL AS csat
              FROM fact_order_items JOIN dim_date ON purchase_date_sk = date_sk GROUP BY year_month
              UNION ALL SELECT year_month, NULL, {money('payment_value')}, NULL
              FROM fact_payments JOIN dim_date ON purchase_date_sk = date_sk GROUP BY year_month
              UNION ALL SELECT year_month, NULL, NULL, avg(review_score)
              FROM fact_reviews JOIN dim_date ON purchase_date_sk = date_sk GROUP BY year_month)
        GROUP BY year_month""",
)
def _(spark, sf):
    star = stored_star(spark, sf, ("dim_date", *FACTS))
    return measure(star, ["total_gmv", "total_payment_value", "csat"], by=["dim_date.year_month"])


BY_CATEGORY = f"""
    SELECT product_category_name_english, {GMV} AS total_gmv
    FROM fact_order_items f LEFT JOIN dim_product p ON f.product_sk = p.product_sk
    GROUP BY product_category_name_english ORDER BY total_gmv DESC NULLS LAST, product_category_name_english"""


@register("top_categories", f"{BY_CATEGORY} LIMIT 5")
def _(spark, sf):
    return analyses.top_categories(gold(spark, sf), 5)  # fewer than there are, so the limit takes effect


@register(
    "topn_filter_join",
    f"""SELECT order_item_sk, product_sk, gmv_item FROM fact_order_items WHERE product_sk IN (
          SELECT product_sk FROM dim_product WHERE product_category_name_english IN (
            SELECT product_category_name_english FROM ({BY_CATEGORY} LIMIT 3)))""",
)
def _(spark, sf):
    return analyses.in_top_categories(gold(spark, sf), 3).select("order_item_sk", "product_sk", "gmv_item")


@register(
    "state_drillthrough",
    _scalars(
        analyses.ALL_MEASURES,
        {
            "fact_order_items": "WHERE customer_sk IN (SELECT customer_sk FROM dim_customer WHERE customer_state = 'SE')",
            "dim_customer": "WHERE customer_state = 'SE'",
        },
    ),
)
def _(spark, sf):
    return analyses.state_drillthrough(stored_star(spark, sf), "SE")


@register(
    "measure_by",
    f"""SELECT customer_state, quarter, {GMV} AS total_gmv, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT seller_id) AS seller_count
        FROM fact_order_items f JOIN dim_customer c ON f.customer_sk = c.customer_sk
        JOIN dim_date d ON f.purchase_date_sk = d.date_sk GROUP BY customer_state, quarter""",
)
def _(spark, sf):
    names = ["total_gmv", "total_orders", "seller_count"]
    return measure(gold(spark, sf), names, by=["dim_customer.customer_state", "dim_date.quarter"])


@register(
    "measure_by_seller_state",
    f"""SELECT seller_state, year, {GMV} AS total_gmv
        FROM fact_order_items f JOIN dim_seller s ON f.seller_sk = s.seller_sk
        JOIN dim_date d ON f.purchase_date_sk = d.date_sk GROUP BY seller_state, year""",
)
def _(spark, sf):
    return measure(gold(spark, sf), ["total_gmv"], by=["dim_seller.seller_state", "dim_date.year"])


# -- reports ------------------------------------------------------------------------------------------------------


@register(
    "shopping_trips",
    """SELECT count(DISTINCT review_id) AS carts, CAST(count(*) AS BIGINT) AS cart_orders,
              count(*) / count(DISTINCT review_id) AS orders_per_cart
       FROM (SELECT DISTINCT review_id, order_id FROM silver_reviews)""",
)
def _(spark, sf):
    return analyses.shopping_trips(current(spark, sf, "reviews"))


@register(
    "split_carts",
    """SELECT 'orders_of_review' AS kind, review_id AS id, count(DISTINCT order_id) AS n FROM silver_reviews
       GROUP BY review_id HAVING count(DISTINCT order_id) > 1
       UNION ALL SELECT 'reviews_of_order', order_id, count(DISTINCT review_id) FROM silver_reviews
       GROUP BY order_id HAVING count(DISTINCT review_id) > 1""",
)
def _(spark, sf):
    reviews = current(spark, sf, "reviews")
    kinds = {"orders_of_review": ("review_id", "order_id"), "reviews_of_order": ("order_id", "review_id")}
    parts = [
        analyses.split_carts(reviews, one, many).select(F.lit(kind).alias("kind"), F.col(one).alias("id"), "n")
        for kind, (one, many) in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


@register(
    "true_carts",
    """SELECT customer_unique_id, min(t) AS cart_start, max(t) AS cart_end, count(*) AS orders
       FROM (SELECT *, sum(starts) OVER (PARTITION BY customer_unique_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS cart
             FROM (SELECT customer_unique_id, order_purchase_timestamp AS t,
                          CASE WHEN order_purchase_timestamp - lag(order_purchase_timestamp) OVER (
                              PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp)
                              <= INTERVAL 1 SECOND THEN 0 ELSE 1 END AS starts
                   FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id))
       GROUP BY customer_unique_id, cart""",
)
def _(spark, sf):
    return analyses.true_carts(current(spark, sf, "orders"), current(spark, sf, "customers"))


@register(
    "customer_ltv",
    f"""SELECT customer_unique_id, {GMV} AS lifetime_gmv, count(DISTINCT order_id) AS orders,
               count(DISTINCT order_id) > 1 AS is_repeat
        FROM fact_order_items f JOIN dim_customer c ON f.customer_sk = c.customer_sk GROUP BY customer_unique_id""",
)
def _(spark, sf):
    return analyses.customer_ltv(gold(spark, sf))


@register(
    "order_total_value",
    f"SELECT order_id, {money('payment_value')} AS order_value FROM silver_payments GROUP BY order_id",
)
def _(spark, sf):
    return analyses.order_total_value(current(spark, sf, "payments"))


@register(
    "multi_payment_rate",
    """SELECT count(*) AS paid_orders, count(*) FILTER (WHERE n > 1) AS multi_payment_orders,
              count(*) FILTER (WHERE n > 1) / count(*) AS rate
       FROM (SELECT order_id, count(*) AS n FROM silver_payments GROUP BY order_id)""",
)
def _(spark, sf):
    return analyses.multi_payment_rate(current(spark, sf, "payments"))


@register(
    "box_size",
    """SELECT units, count(*) AS orders, CASE WHEN units = 1 THEN 'single' ELSE 'multi' END AS box
       FROM (SELECT order_id, count(*) AS units FROM silver_items GROUP BY order_id) GROUP BY units""",
)
def _(spark, sf):
    return analyses.box_size(current(spark, sf, "order_items"))


def _geo(side):
    state, dim = f"{side}_state", f"dim_{side}"

    @register(
        f"geo_concentration_{side}" if side == "seller" else "geo_concentration",
        f"""WITH by_state AS (
                SELECT {state}, {GMV} AS total_gmv FROM fact_order_items f JOIN {dim} d ON f.{side}_sk = d.{side}_sk
                GROUP BY {state})
            SELECT {state}, total_gmv,
                   total_gmv / CAST(sum(CAST(total_gmv AS DECIMAL(28,2))) OVER () AS DOUBLE) AS share,
                   CAST(sum(CAST(total_gmv AS DECIMAL(28,2))) OVER (ORDER BY total_gmv DESC, {state}
                        ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                     / CAST(sum(CAST(total_gmv AS DECIMAL(28,2))) OVER () AS DOUBLE) AS cumulative_share
            FROM by_state""",
    )
    def _(spark, sf):
        return analyses.geo_concentration(gold(spark, sf), dim, state)


_geo("customer")
_geo("seller")


@register(
    "installment_analysis",
    f"""SELECT payment_installments, count(DISTINCT order_id) AS orders, {money('payment_value')} AS paid_value,
               round(avg(monthly_instalment_value), 4) AS mean_monthly_instalment
        FROM fact_payments GROUP BY payment_installments""",
)
def _(spark, sf):
    return analyses.installment_analysis(gold(spark, sf).bare("fact_payments"))


@register(
    "logistics_gap",
    """SELECT order_status, count(*) FILTER (WHERE order_approved_at IS NULL) AS no_order_approved_at,
              count(*) FILTER (WHERE order_delivered_carrier_date IS NULL) AS no_order_delivered_carrier_date,
              count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS no_order_delivered_customer_date
       FROM prep_orders GROUP BY order_status""",
)
def _(spark, sf):
    return analyses.logistics_gap(prepared(spark, sf, "orders"))
