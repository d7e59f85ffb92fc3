from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set, item, order, rows
from tidemark.plans import analyses, medallion, silver, star
from tidemark.plans.metrics import MEASURES, measure

NOW = datetime(2024, 5, 6, 7, 8, 9)

GOLD_COLUMNS = {
    "dim_date": "date_sk date_actual year quarter month month_name month_short year_month week_of_year day_of_month "
    "day_of_week day_name day_short is_weekend fiscal_year fiscal_quarter",
    "dim_customer": "customer_sk customer_id customer_unique_id customer_zip_code_prefix customer_city customer_state "
    "_silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
    "dim_seller": "seller_sk seller_id seller_zip_code_prefix seller_city seller_state "
    "_silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
    "dim_product": "product_sk product_id product_category_name product_category_name_english product_name_length "
    "product_description_length product_photos_qty product_weight_g product_length_cm product_height_cm "
    "product_width_cm _silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
    "dim_order": "order_sk customer_sk purchase_date_sk order_id customer_id order_status order_purchase_timestamp "
    "order_approved_at order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date "
    "delivery_days estimated_days delivery_delta_days is_on_time is_delivered "
    "_silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
    "fact_order_items": "order_item_sk order_sk product_sk seller_sk customer_sk purchase_date_sk order_id "
    "order_item_id product_id seller_id price freight_value gmv_item shipping_limit_date "
    "_silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
    "fact_payments": "payment_sk order_sk purchase_date_sk order_id payment_sequential payment_type "
    "payment_installments payment_value monthly_instalment_value "
    "_silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
    "fact_reviews": "review_sk order_sk purchase_date_sk review_id order_id review_score review_creation_date "
    "review_answer_timestamp has_comment_title has_comment_message "
    "_silver_processed_at _gold_processed_at OP AR_H_COMMIT_TIMESTAMP",
}
TYPES = {"order_sk": "bigint", "purchase_date_sk": "bigint", "delivery_days": "int", "gmv_item": "double"}
TYPES |= {"is_on_time": "boolean", "order_purchase_timestamp": "timestamp", "_gold_processed_at": "timestamp_ntz"}


@pytest.fixture
def shop(spark):
    def customer(n, state):
        return {"customer_id": f"c-o{n}", "customer_unique_id": "u", "customer_state": state, "OP": "I"}

    data = {
        "orders": [order("o1", bought="2018-01-30 10:00:00"), order("o2", bought="2018-02-01 10:00:00", status="delivered")],
        "order_items": [item("o1", 1, 10.0), item("o1", 2, 20.0, seller_id="s2"), item("o2", 1, 5.0, product_id="px")],
        "customers": [customer(1, "SP"), customer(2, "RJ")],
        "sellers": [{"seller_id": s, "seller_state": "SP", "OP": "I"} for s in ("s1", "s2")],
        "products": [{"product_id": "p1", "product_category_name": "automotivo", "OP": "I"}],
        "product_category_name_translation": [
            {"product_category_name": "automotivo", "product_category_name_english": "auto", "OP": "I"}
        ],
        "payments": [
            {"order_id": "o1", "payment_sequential": n, "payment_type": "boleto", "payment_installments": 2, "payment_value": v, "OP": "I"}
            for n, v in ((1, 30.0), (2, 5.0))
        ],
        "reviews": [{"review_id": "r1", "order_id": o, "review_score": s, "OP": "I"} for o, s in (("o1", 5), ("o2", 2))],
    }
    tables = {e: rows(spark, e, *d) for e, d in data.items()}
    return medallion.build_star(lambda e: silver.current(tables[e], e, NOW), NOW)


def test_schemas(shop):
    for name, names in GOLD_COLUMNS.items():
        assert shop[name].columns == names.split(), name
        for column, kind in shop[name].dtypes:
            assert kind == TYPES.get(column, kind), (name, column)


def test_calendar_runs_a_year_past_the_last_purchase(shop):
    r = shop["dim_date"].agg(F.min("date_actual").alias("a"), F.max("date_actual").alias("b"), F.count("*").alias("n")).first()
    assert (str(r.a), str(r.b), r.n) == ("2018-01-30", "2019-02-01", 368)


def test_computed_purchase_key_equals_the_join(spark, shop):
    orders = silver.current(rows(spark, "orders", order("o1"), order("o2")), "orders", NOW)
    joined = star.dim_order(orders, star.dim_date(orders), NOW)
    computed = star.dim_order(orders, None, NOW)
    assert as_set(joined, *joined.columns) == as_set(computed, *joined.columns)


def test_several_payments_do_not_multiply_sales(shop):
    r = measure(shop, ["total_gmv", "total_payment_value", "csat"], by=["dim_date.year_month"]).collect()
    got = {x.year_month: (x.total_gmv, x.total_payment_value, x.csat) for x in r}
    assert got == {"2018-01": (35.0, 35.0, 5.0), "2018-02": (7.5, None, 2.0)}


def test_a_product_without_member_keeps_its_sales(shop):
    got = measure(shop, ["total_gmv"], by=["dim_product.product_category_name_english"])
    assert as_set(got, "product_category_name_english", "total_gmv") == {("auto", 35.0), (None, 7.5)}


def test_a_state_filters_only_what_it_reaches(shop):
    r = analyses.state_drillthrough(shop, "SP").first()
    assert (r.total_gmv, r.total_orders, r.total_customers, r.seller_count) == (35.0, 1, 1, 2)
    assert (r.csat, r.total_payment_value) == (3.5, 35.0)


def test_grouping_out_of_reach_is_refused(shop):
    with pytest.raises(ValueError, match="does not reach"):
        measure(shop, ["csat"], by=["dim_customer.customer_state"])


def test_all_measures_of_an_empty_shop(shop):
    empty = {n: shop[n].filter(F.lit(False)) for n in shop}
    r = measure(empty, list(MEASURES)).first()
    assert r.total_gmv is None and r.aov is None and r.on_time_pct is None and r.total_orders == 0


def test_on_time_counts_every_on_time_order(spark, shop):
    orders = shop["dim_order"].withColumns({"is_on_time": F.lit(True), "is_delivered": F.col("order_id") == "o2"})
    assert measure({"dim_order": orders}, ["on_time_pct"]).first().on_time_pct == 2.0


def test_late_orders_repair_their_facts(spark, shop):
    items = silver.current(rows(spark, "order_items", item("o1"), item("o9")), "order_items", NOW)
    facts = star.fact_order_items(items, shop["dim_order"], NOW)
    assert facts.filter("order_sk is null").count() == 1
    o9 = star.dim_order(silver.current(rows(spark, "orders", order("o9")), "orders", NOW), None, NOW)
    repaired = star.repair_order_keys(facts, shop["dim_order"].unionByName(o9))
    assert repaired.count() == 2 and repaired.filter("order_sk is null").count() == 0
