"""Common table expressions, in DuckDB's SQL, that restate the tables the queries start from."""

from __future__ import annotations

import re

from tidemark.entities import ENTITIES, ORDER_STATUSES, PAYMENT_TYPES, STATES
from tidemark.functions.commerce import STATE_NAMES
from tidemark.sources.testbed import CATEGORIES, ENGLISH, LOAD_TS, PAID_BY

NOW_DAY = "DATE '2001-12-31'"
NOW_CLOCK = "INTERVAL '12 hours 34 minutes 56 seconds'"
LOAD = f"TIMESTAMP '{LOAD_TS}'"


def texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def case(column: str, values: dict[str, str], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def sk(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"


def on_day(value: str) -> str:
    return f"(CAST({value} AS DATE) + {NOW_CLOCK})"


def money(value: str) -> str:
    return f"round(sum(CAST({value} AS DOUBLE)), 2)"


def _state(key: str) -> str:
    return f"CASE WHEN {key} = 24 THEN 'XX' WHEN {key} < 23 THEN ([{texts(STATES)}])[{key} + 1] END"


BOUGHT = "CASE WHEN o_orderkey % 997 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400) END"

CTES: dict[str, str] = {
    "raw_customers": f"""
        SELECT 'C' || o_orderkey AS customer_id, 'U' || o_custkey AS customer_unique_id,
               c_custkey * 7 % 99999 AS customer_zip_code_prefix, ' ' || n_name || ' ' AS customer_city,
               {_state('c_nationkey')} AS customer_state, 'I' AS "OP", {BOUGHT} AS "AR_H_COMMIT_TIMESTAMP"
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "raw_sellers": f"""
        SELECT 'S' || s_suppkey AS seller_id, s_suppkey * 11 % 99999 AS seller_zip_code_prefix,
               n_name AS seller_city, {_state('s_nationkey')} AS seller_state,
               'I' AS "OP", {LOAD} AS "AR_H_COMMIT_TIMESTAMP"
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_products": f"""
        SELECT 'P' || p_partkey AS product_id, {case('p_type', CATEGORIES)} AS product_category_name,
               CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
               p_retailprice AS product_description_lenght,
               CAST(p_partkey % 7 AS DOUBLE) AS product_photos_qty, CAST(p_size - 2 AS DOUBLE) AS product_weight_g,
               CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey % 60 - 1 AS DOUBLE) END AS product_length_cm,
               CAST(p_partkey % 50 AS DOUBLE) AS product_height_cm, CAST(p_size AS DOUBLE) AS product_width_cm,
               'I' AS "OP", {LOAD} AS "AR_H_COMMIT_TIMESTAMP"
        FROM part""",
    "raw_translation": f"""
        SELECT DISTINCT product_category_name, {case('product_category_name', ENGLISH)} AS product_category_name_english,
               'I' AS "OP", {LOAD} AS "AR_H_COMMIT_TIMESTAMP"
        FROM (SELECT coalesce({case('p_type', CATEGORIES)}, 'sem_categoria') AS product_category_name FROM part)
        WHERE product_category_name IN ({texts(ENGLISH)})""",
    "raw_orders": f"""
        SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
               'I' AS "OP",
               coalesce(order_delivered_customer_date, order_purchase_timestamp) AS "AR_H_COMMIT_TIMESTAMP"
        FROM (SELECT 'O' || o_orderkey AS order_id, 'C' || o_orderkey AS customer_id,
                     CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
                          WHEN o_orderkey % 50 = 0 THEN 'bogus' ELSE 'processing' END AS order_status,
                     b AS order_purchase_timestamp, b + INTERVAL 1 HOUR AS order_approved_at,
                     b + INTERVAL 2 DAY AS order_delivered_carrier_date,
                     CASE WHEN o_orderstatus = 'F' THEN b + to_days(CAST(o_orderkey % 40 AS INTEGER)) END
                         AS order_delivered_customer_date,
                     CAST(b AS DATE) + INTERVAL 20 DAY AS order_estimated_delivery_date
              FROM (SELECT *, {BOUGHT} AS b FROM orders))""",
    "raw_items": """
        SELECT 'O' || l_orderkey AS order_id, l_linenumber AS order_item_id, 'P' || l_partkey AS product_id,
               'S' || l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CASE WHEN l_partkey % 500 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS price,
               round(l_quantity * 0.5, 2) AS freight_value,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'D' WHEN l_returnflag = 'A' THEN 'U'
                    ELSE 'I' END AS "OP",
               l_shipdate + to_seconds(l_partkey) AS "AR_H_COMMIT_TIMESTAMP"
        FROM lineitem""",
    "raw_payments": f"""
        SELECT 'O' || o_orderkey AS order_id, 1 AS payment_sequential,
               {case('substr(o_orderpriority, 1, 1)', PAID_BY)} AS payment_type,
               CAST(o_orderkey % 13 AS INTEGER) AS payment_installments, o_totalprice AS payment_value,
               'I' AS "OP", {BOUGHT} AS "AR_H_COMMIT_TIMESTAMP"
        FROM orders
        UNION ALL
        SELECT 'O' || o_orderkey, 2, 'voucher', 1, CAST(10 AS DOUBLE), 'I', {BOUGHT} FROM orders
        WHERE o_orderkey % 23 = 0""",
    "raw_reviews": """
        SELECT 'R' || CASE WHEN event_id % 10 < 2 THEN event_id - event_id % 2 ELSE event_id END AS review_id,
               'O' || CASE WHEN event_id % 10 IN (4, 5) THEN event_id - event_id % 2 ELSE event_id END AS order_id, CAST(CAST(floor(value) AS BIGINT) % 7 AS INTEGER) AS review_score,
               CASE WHEN event_id % 3 <> 0 THEN 'title ' || event_id END AS review_comment_title,
               CASE WHEN event_id % 2 <> 0 THEN props END AS review_comment_message,
               CAST(ts AS DATE) AS review_creation_date, ts + to_hours(event_id % 72) AS review_answer_timestamp,
               'I' AS "OP", CAST(CAST(ts AS DATE) AS TIMESTAMP) AS "AR_H_COMMIT_TIMESTAMP"
        FROM events""",
    "user_changes": """
        SELECT user_id, event_id, event_type, value,
               CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS "OP",
               ts AS "AR_H_COMMIT_TIMESTAMP"
        FROM events""",
}

SHORT = {
    "customers": "customers",
    "sellers": "sellers",
    "products": "products",
    "product_category_name_translation": "translation",
    "orders": "orders",
    "order_items": "items",
    "payments": "payments",
    "reviews": "reviews",
}
_RULES = {
    "customers": [(f"customer_state IN ({texts(STATES)})", "invalid_state")],
    "sellers": [(f"seller_state IN ({texts(STATES)})", "invalid_state")],
    "products": [
        (f"(product_{c} IS NULL OR product_{c} > 0)", f"non_positive_{c.split('_')[0]}")
        for c in ("weight_g", "length_cm", "height_cm", "width_cm")
    ],
    "translation": [],
    "orders": [
        (f"order_status IN ({texts(ORDER_STATUSES)})", "invalid_order_status"),
        ("order_purchase_timestamp IS NOT NULL", "null_purchase_timestamp"),
        ("customer_id IS NOT NULL", "null_customer_id"),
    ],
    "items": [
        ("price >= 0", "negative_price"),
        ("freight_value >= 0", "negative_freight_value"),
        ("order_id IS NOT NULL", "null_order_id"),
        ("product_id IS NOT NULL", "null_product_id"),
        ("seller_id IS NOT NULL", "null_seller_id"),
    ],
    "payments": [
        (f"payment_type IN ({texts(PAYMENT_TYPES)})", "invalid_payment_type"),
        ("payment_value >= 0", "negative_payment_value"),
        ("payment_installments > 0", "invalid_installments"),
    ],
    "reviews": [("review_score BETWEEN 1 AND 5", "invalid_review_score")],
}
_TRIMMED = {
    "customers": "* REPLACE (trim(customer_city) AS customer_city)",
    "products": "* EXCLUDE (product_name_lenght, product_description_lenght) "
    "REPLACE (coalesce(product_category_name, 'sem categoria') AS product_category_name), "
    "product_name_lenght AS product_name_length, product_description_lenght AS product_description_length",
    "orders": "*, CAST(order_purchase_timestamp AS DATE) AS purchase_date",
    "reviews": "* REPLACE (trim(review_comment_title) AS review_comment_title, "
    "trim(review_comment_message) AS review_comment_message)",
}

for _entity, _short in SHORT.items():
    _keys = ENTITIES[_entity].keys
    CTES[f"recv_{_short}"] = f"""
        SELECT *, coalesce(CAST("AR_H_COMMIT_TIMESTAMP" AS DATE), {NOW_DAY}) + {NOW_CLOCK} AS _ingested_at
        FROM raw_{_short}"""
    CTES[f"prep_{_short}"] = f"SELECT {_TRIMMED.get(_short, '*')} FROM recv_{_short}"
    _null_key = " OR ".join(f"{k} IS NULL" for k in _keys)
    _broken = " ".join(f"WHEN NOT coalesce({c}, false) THEN '{r}'" for c, r in _RULES[_short])
    CTES[f"tag_{_short}"] = f"""
        SELECT *, CASE WHEN "OP" = 'D' THEN NULL {_broken} WHEN {_null_key} THEN 'null_pk' END AS _quarantine_reason
        FROM prep_{_short}"""
    _open = " ".join(f"WHEN ({c}) IS NULL THEN '?' WHEN NOT ({c}) THEN '{r}'" for c, r in _RULES[_short])
    CTES[f"parity_{_short}"] = f"""
        SELECT * FROM (
            SELECT *, CASE WHEN "OP" = 'D' THEN NULL {_open} WHEN {_null_key} THEN 'null_pk' END AS _quarantine_reason
            FROM prep_{_short})
        WHERE _quarantine_reason IS NULL OR _quarantine_reason <> '?'"""
    CTES[f"clean_{_short}"] = f"""
        SELECT * EXCLUDE (_quarantine_reason),
               CASE WHEN "OP" <> 'D' THEN {on_day('_ingested_at')} END AS _silver_processed_at
        FROM tag_{_short} WHERE _quarantine_reason IS NULL"""
    for _prefix, _from in (("bad", "tag"), ("badparity", "parity")):
        CTES[f"{_prefix}_{_short}"] = f"""
            SELECT *, '{_entity}' AS _quarantine_table_name, CAST(_ingested_at AS DATE) AS _quarantine_date,
                   {on_day('_ingested_at')} AS _quarantine_failed_at
            FROM {_from}_{_short} WHERE _quarantine_reason IS NOT NULL"""
    CTES[f"silver_{_short}"] = f"""
        SELECT * FROM (
            SELECT * FROM clean_{_short}
            QUALIFY row_number() OVER (PARTITION BY {', '.join(_keys)}
                ORDER BY coalesce("AR_H_COMMIT_TIMESTAMP", _ingested_at) DESC) = 1)
        WHERE "OP" <> 'D'"""

_TAIL = f'_silver_processed_at, {on_day("_silver_processed_at")} AS _gold_processed_at, "OP", "AR_H_COMMIT_TIMESTAMP"'


def delivery_columns() -> str:
    delivered, bought = "order_delivered_customer_date", "order_purchase_timestamp"
    promised = "order_estimated_delivery_date"
    return f"""
        CAST(date_diff('day', {bought}, {delivered}) AS INTEGER) AS delivery_days,
        CAST(date_diff('day', {bought}, {promised}) AS INTEGER) AS estimated_days,
        CAST(date_diff('day', {bought}, {delivered}) - date_diff('day', {bought}, {promised}) AS INTEGER)
            AS delivery_delta_days,
        {delivered} <= {promised} AS is_on_time, order_status = 'delivered' AS is_delivered"""


CALENDAR = """
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_short, strftime(d, '%Y-%m') AS year_month,
    CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
    CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name, strftime(d, '%a') AS day_short,
    dayofweek(d) IN (0, 6) AS is_weekend, CAST(year(d) AS INTEGER) AS fiscal_year,
    CAST(quarter(d) AS INTEGER) AS fiscal_quarter"""

CTES |= {
    "bounds": """
        SELECT min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase
        FROM silver_orders""",
    "spine": """
        SELECT CAST(unnest(generate_series(CAST(CAST(first_purchase AS DATE) AS TIMESTAMP),
            CAST(last_purchase AS DATE) + INTERVAL 12 MONTH, INTERVAL 1 DAY)) AS DATE) AS d
        FROM bounds""",
    "dim_date": f"SELECT {sk('d')} AS date_sk, d AS date_actual, {CALENDAR} FROM spine",
    "dim_customer": f"""
        SELECT {sk('customer_id')} AS customer_sk, customer_id, customer_unique_id, customer_zip_code_prefix,
               customer_city, customer_state, {_TAIL} FROM silver_customers""",
    "dim_seller": f"""
        SELECT {sk('seller_id')} AS seller_sk, seller_id, seller_zip_code_prefix, seller_city, seller_state, {_TAIL}
        FROM silver_sellers""",
    "dim_product": f"""
        SELECT {sk('product_id')} AS product_sk, product_id, p.product_category_name,
               coalesce(product_category_name_english, p.product_category_name) AS product_category_name_english,
               product_name_length, product_description_length, product_photos_qty, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm, {_TAIL}
        FROM silver_products p
        LEFT JOIN (SELECT product_category_name, product_category_name_english FROM silver_translation) t
        ON p.product_category_name = t.product_category_name""",
    "dim_order": f"""
        SELECT {sk('order_id')} AS order_sk, {sk('customer_id')} AS customer_sk, date_sk AS purchase_date_sk, order_id,
               customer_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date, {delivery_columns()}, {_TAIL}
        FROM silver_orders LEFT JOIN dim_date ON purchase_date = date_actual""",
    "fact_order_items": f"""
        SELECT {sk('i.order_id', 'order_item_id')} AS order_item_sk, order_sk, {sk('product_id')} AS product_sk,
               {sk('seller_id')} AS seller_sk, customer_sk, purchase_date_sk, i.order_id, order_item_id, product_id,
               seller_id, price, freight_value, price + freight_value AS gmv_item, shipping_limit_date, {_TAIL}
        FROM silver_items i LEFT JOIN (SELECT order_id, order_sk, customer_sk, purchase_date_sk FROM dim_order) o
        ON i.order_id = o.order_id""",
    "fact_payments": f"""
        SELECT {sk('p.order_id', 'payment_sequential')} AS payment_sk, order_sk, purchase_date_sk, p.order_id,
               payment_sequential, payment_type, payment_installments, payment_value,
               CASE WHEN payment_installments > 0 THEN payment_value / payment_installments END
                   AS monthly_instalment_value, {_TAIL}
        FROM silver_payments p LEFT JOIN (SELECT order_id, order_sk, purchase_date_sk FROM dim_order) o
        ON p.order_id = o.order_id""",
    "fact_reviews": f"""
        SELECT {sk('review_id', 'r.order_id')} AS review_sk, order_sk, purchase_date_sk, review_id, r.order_id,
               review_score, review_creation_date, review_answer_timestamp,
               review_comment_title IS NOT NULL AS has_comment_title,
               review_comment_message IS NOT NULL AS has_comment_message, {_TAIL}
        FROM silver_reviews r LEFT JOIN (SELECT order_id, order_sk, purchase_date_sk FROM dim_order) o
        ON r.order_id = o.order_id""",
}

STATE_FULL = case("customer_state", STATE_NAMES, "customer_state")


def expand(sql: str) -> str:
    """Prefix the common table expressions a statement uses, in the order they depend on each other."""
    used: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_]+", text):
            if word in CTES and word not in used:
                visit(CTES[word])
                if word not in used:
                    used.append(word)

    visit(sql)
    if not used:
        return sql.strip()
    clauses = ",\n".join(f"{name} AS ({CTES[name]})" for name in used)
    lead = f"WITH {clauses}\n"
    body = sql.strip()
    return f"WITH {clauses},\n{body[5:]}" if body.upper().startswith("WITH ") else lead + body
