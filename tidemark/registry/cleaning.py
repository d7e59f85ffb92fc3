"""Column operators, row rules, and the clean and quarantined side of every entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES, MISSPELLED, OP, STATES
from tidemark.functions import calendar, columns, commerce
from tidemark.functions.keys import surrogate_key
from tidemark.operators import quality
from tidemark.operators.cdc import union_by_name
from tidemark.plans import analyses, star
from tidemark.registry.base import (
    KEY_MODE,
    NOW,
    cleaned,
    current,
    gold,
    prepared,
    quarantined,
    raw,
    received,
    register,
)
from tidemark.registry.sql import CALENDAR, SHORT, STATE_FULL, delivery_columns, on_day, sk, texts

# -- column operators ---------------------------------------------------------------------------------------------


@register("trim_all_strings", "SELECT * REPLACE (trim(customer_city) AS customer_city) FROM raw_customers")
def _(spark, sf):
    return columns.trim_all_strings(raw(spark, sf, "customers"))


@register(
    "cast_columns",
    """SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value,
              TRY_CAST(order_id AS INTEGER) AS order_number, 'order_number' AS malformed FROM raw_payments""",
)
def _(spark, sf):
    payments = raw(spark, sf, "payments").withColumn("payment_type", F.upper("payment_type"))
    as_text = payments.select(*[F.col(c).cast("string") for c in ENTITIES["payments"].columns.fieldNames()])
    casts = {**ENTITIES["payments"].casts, "payment_type": "string", "order_number": "int", "absent": "int"}
    return columns.cast_columns(as_text.withColumn("order_number", F.col("order_id")), casts, flag="malformed")


@register(
    "default_category",
    "SELECT product_id, coalesce(product_category_name, 'sem categoria') AS product_category_name FROM raw_products",
)
def _(spark, sf):
    return columns.default_category(raw(spark, sf, "products").select("product_id", "product_category_name"))


@register(
    "rename_columns",
    """SELECT product_id, product_name_lenght AS product_name_length,
              product_description_lenght AS product_description_length FROM raw_products""",
)
def _(spark, sf):
    return columns.correct_names(raw(spark, sf, "products").select("product_id", *MISSPELLED), MISSPELLED)


@register(
    "purchase_date",
    "SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS purchase_date FROM raw_orders",
)
def _(spark, sf):
    return columns.with_purchase_date(raw(spark, sf, "orders")).select("order_id", "purchase_date")


@register(
    "stage_timestamp",
    f"SELECT order_id, _ingested_at, {on_day('order_purchase_timestamp')} AS stamped FROM recv_orders",
)
def _(spark, sf):
    stamp = columns.on_day(F.col("order_purchase_timestamp"), NOW)
    return received(spark, sf, "orders").select("order_id", "_ingested_at", stamp.alias("stamped"))


@register(
    "surrogate_key",
    f"""SELECT order_id, order_item_id, {sk('order_id', 'order_item_id')} AS order_item_sk,
               {sk('product_id')} AS product_sk FROM raw_items""",
)
def _(spark, sf):
    return raw(spark, sf, "order_items").select(
        "order_id",
        "order_item_id",
        surrogate_key("order_id", "order_item_id", mode=KEY_MODE).alias("order_item_sk"),
        surrogate_key("product_id", mode=KEY_MODE).alias("product_sk"),
    )


@register("date_spine", "SELECT d AS date_actual FROM spine")
def _(spark, sf):
    return calendar.date_spine(calendar.purchase_bounds(current(spark, sf, "orders")))


@register("purchase_bounds", "SELECT first_purchase, last_purchase FROM bounds")
def _(spark, sf):
    return calendar.purchase_bounds(current(spark, sf, "orders"))


@register(
    "calendar_attributes",
    f"SELECT order_id, {CALENDAR} FROM (SELECT order_id, purchase_date AS d FROM prep_orders WHERE purchase_date IS NOT NULL)",
)
def _(spark, sf):
    days = prepared(spark, sf, "orders").filter(F.col("purchase_date").isNotNull())
    attributes = calendar.calendar_attributes("purchase_date")
    return days.select("order_id", *[c.alias(n) for n, c in attributes.items()])


def _order_metric(name, column, sql=None):
    sql = sql or f"SELECT order_id, {name} FROM (SELECT order_id, {delivery_columns()} FROM prep_orders)"

    @register(name, sql)
    def _(spark, sf):
        return prepared(spark, sf, "orders").select("order_id", column().alias(name))


_order_metric("delivery_days", commerce.delivery_days)
_order_metric("estimated_days", commerce.estimated_days)
_order_metric("delivery_delta_days", commerce.delivery_delta_days)
_order_metric("is_on_time", commerce.is_on_time)
_order_metric("is_delivered", commerce.is_delivered)
_order_metric(
    "is_late",
    commerce.is_late,
    "SELECT order_id, order_delivered_customer_date > order_estimated_delivery_date AS is_late FROM prep_orders",
)


@register("gmv_item", "SELECT order_id, order_item_id, price + freight_value AS gmv_item FROM prep_items")
def _(spark, sf):
    rows = prepared(spark, sf, "order_items")
    return rows.select("order_id", "order_item_id", commerce.gmv_item().alias("gmv_item"))


@register(
    "monthly_instalment_value",
    """SELECT order_id, payment_sequential, CASE WHEN payment_installments > 0
              THEN payment_value / payment_installments END AS monthly_instalment_value FROM prep_payments""",
)
def _(spark, sf):
    value = commerce.monthly_instalment_value().alias("monthly_instalment_value")
    return prepared(spark, sf, "payments").select("order_id", "payment_sequential", value)


@register(
    "has_comment_flags",
    """SELECT review_id, order_id, review_comment_title IS NOT NULL AS has_comment_title,
              review_comment_message IS NOT NULL AS has_comment_message FROM prep_reviews""",
)
def _(spark, sf):
    flags = [c.alias(n) for n, c in commerce.comment_flags().items()]
    return prepared(spark, sf, "reviews").select("review_id", "order_id", *flags)


@register("category_english", "SELECT product_id, product_category_name_english FROM dim_product")
def _(spark, sf):
    names = current(spark, sf, "product_category_name_translation")
    joined = star.join_translation(current(spark, sf, "products"), names)
    return joined.select("product_id", commerce.category_english().alias("product_category_name_english"))


@register(
    "ntz_to_ltz",
    "SELECT order_id, order_purchase_timestamp, order_approved_at, order_delivered_customer_date FROM prep_orders",
)
def _(spark, sf):
    names = ("order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date")
    moved = columns.to_instant(*names)
    return prepared(spark, sf, "orders").select("order_id", *[c.alias(n) for n, c in moved.items()])


@register(
    "sequence_key",
    'SELECT order_id, coalesce("AR_H_COMMIT_TIMESTAMP", _ingested_at) AS sequence_key FROM recv_orders',
)
def _(spark, sf):
    key = columns.sequence_key(COMMIT_TS, "_ingested_at").alias("sequence_key")
    return received(spark, sf, "orders").select("order_id", key)


@register(
    "geo_enrich",
    f"SELECT customer_id, customer_state, 'Brazil' AS country, {STATE_FULL} AS state_full FROM prep_customers",
)
def _(spark, sf):
    return commerce.geo_enrich(prepared(spark, sf, "customers").select("customer_id", "customer_state"))


@register(
    "review_response_time",
    """SELECT review_id, order_id,
              CAST(floor(epoch(review_answer_timestamp - CAST(review_creation_date AS TIMESTAMP)) / 3600) AS BIGINT)
                  AS response_hours FROM prep_reviews""",
)
def _(spark, sf):
    hours = commerce.review_response_hours().alias("response_hours")
    return prepared(spark, sf, "reviews").select("review_id", "order_id", hours)


# -- rules --------------------------------------------------------------------------------------------------------


@register(
    "split_on_null_pk",
    """SELECT customer_id, customer_state, customer_id IS NOT NULL AND customer_state IS NOT NULL AS has_key
       FROM prep_customers""",
)
def _(spark, sf):
    rows = prepared(spark, sf, "customers").select("customer_id", "customer_state")
    whole, partial = quality.split_on_null_pk(rows, ["customer_id", "customer_state"])
    return whole.withColumn("has_key", F.lit(True)).unionByName(partial.withColumn("has_key", F.lit(False)))


@register(
    "apply_rules",
    'SELECT order_id, order_item_id, "AR_H_COMMIT_TIMESTAMP", _quarantine_reason FROM tag_items',
)
def _(spark, sf):
    spec = ENTITIES["order_items"]
    rows = quality.apply_rules(prepared(spark, sf, "order_items"), spec.rules, spec.keys)
    return rows.select("order_id", "order_item_id", COMMIT_TS, quality.REASON)


@register(
    "collect_rejected",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, {' || '.join(f'CAST({k} AS VARCHAR)' for k in ENTITIES[e].keys)} AS row_key, "
        f"_quarantine_reason FROM bad_{s}"
        for e, s in SHORT.items()
    ),
)
def _(spark, sf):
    parts = []
    for entity, spec in ENTITIES.items():
        key = F.concat(*[F.col(k).cast("string") for k in spec.keys]).alias("row_key")
        rows = quarantined(spark, sf, entity)
        parts.append(rows.select(F.lit(entity).alias("table_name"), key, quality.REASON))
    return union_by_name(*parts)


@register(
    "quarantine_metadata",
    """SELECT order_id, payment_sequential, _quarantine_reason, _quarantine_table_name, _quarantine_date,
              _quarantine_failed_at FROM bad_payments""",
)
def _(spark, sf):
    bad = quality.rejected(quality.apply_rules(prepared(spark, sf, "payments"), ENTITIES["payments"].rules))
    marked = quality.quarantine_metadata(bad, "payments", NOW)
    meta = [c for c in marked.columns if c.startswith("_quarantine")]
    return marked.select("order_id", "payment_sequential", *meta)


def _rule_query(name, entity, keys, rule, condition):
    short = SHORT[entity]
    sql = (
        f"SELECT {', '.join(keys)}, CASE WHEN NOT coalesce({condition}, false) THEN '{rule.reason}' END AS reason, "
        f"CASE WHEN NOT ({condition}) THEN '{rule.reason}' END AS reason_parity FROM prep_{short}"
    )

    @register(name, sql)
    def _(spark, sf):
        strict = quality.first_failure([rule])
        lenient = F.when(~F.expr(rule.condition), F.lit(rule.reason))
        return prepared(spark, sf, entity).select(*keys, strict.alias("reason"), lenient.alias("reason_parity"))


_rule_query(
    "rule_in_domain",
    "customers",
    ["customer_id"],
    quality.in_domain("customer_state", STATES, "invalid_state"),
    f"customer_state IN ({texts(STATES)})",
)
_rule_query(
    "rule_non_negative",
    "order_items",
    ["order_id", "order_item_id", "shipping_limit_date"],
    quality.non_negative("price", "negative_price"),
    "price >= 0",
)
_rule_query(
    "rule_null_or_positive",
    "products",
    ["product_id"],
    quality.null_or_positive("product_length_cm", "non_positive_length"),
    "product_length_cm IS NULL OR product_length_cm > 0",
)
_rule_query(
    "rule_between",
    "reviews",
    ["review_id", "order_id"],
    quality.between("review_score", 1, 5, "invalid_review_score"),
    "review_score BETWEEN 1 AND 5",
)
_rule_query(
    "rule_not_null",
    "orders",
    ["order_id"],
    quality.not_null("order_purchase_timestamp", "null_purchase_timestamp"),
    "order_purchase_timestamp IS NOT NULL",
)


def _both_sides(entity):
    short = SHORT[entity]
    name = short if entity == "product_category_name_translation" else entity

    @register(f"clean_{name}", f"SELECT * FROM clean_{short}")
    def _(spark, sf):
        return cleaned(spark, sf, entity)

    @register(f"quarantine_{name}", f"SELECT * FROM bad_{short}")
    def _(spark, sf):
        return quarantined(spark, sf, entity)

    @register(f"quarantine_{name}_parity", f"SELECT * FROM badparity_{short}")
    def _(spark, sf):
        return quarantined(spark, sf, entity, on_null="drop", null_op="drop")


for _entity in ENTITIES:
    _both_sides(_entity)


@register(
    "delete_bypass",
    """SELECT "OP", count(*) AS change_rows, count(*) FILTER (WHERE _quarantine_reason IS NULL) AS passed_rows,
              count(*) FILTER (WHERE _quarantine_reason IS NOT NULL) AS rejected_rows,
              count(*) FILTER (WHERE price < 0) AS negative_prices FROM tag_items GROUP BY "OP" """,
)
def _(spark, sf):
    spec = ENTITIES["order_items"]
    rows = quality.apply_rules(prepared(spark, sf, "order_items"), spec.rules, spec.keys)
    good = F.col(quality.REASON).isNull()
    return rows.groupBy(OP).agg(
        F.count(F.lit(1)).alias("change_rows"),
        F.count_if(good).alias("passed_rows"),
        F.count_if(~good).alias("rejected_rows"),
        F.count_if(F.col("price") < 0).alias("negative_prices"),
    )


@register(
    "audit_queries",
    """SELECT order_id AS audit_key, CAST(sum(b) AS BIGINT) AS bronze, CAST(sum(s) AS BIGINT) AS silver,
              CAST(sum(g) AS BIGINT) AS gold, CAST(sum(q) AS BIGINT) AS quarantine
       FROM (SELECT order_id, 1 AS b, 0 AS s, 0 AS g, 0 AS q FROM recv_items
             UNION ALL SELECT order_id, 0, 1, 0, 0 FROM silver_items
             UNION ALL SELECT order_id, 0, 0, 1, 0 FROM fact_order_items
             UNION ALL SELECT order_id, 0, 0, 0, 1 FROM bad_items) GROUP BY order_id""",
)
def _(spark, sf):
    return analyses.audit(
        F.col("order_id"),
        bronze=received(spark, sf, "order_items"),
        silver=current(spark, sf, "order_items"),
        gold=gold(spark, sf)["fact_order_items"],
        quarantine=quarantined(spark, sf, "order_items"),
    )


@register(
    "quarantine_report",
    "SELECT _quarantine_table_name, _quarantine_reason, _quarantine_date, count(*) AS rejected_rows FROM ("
    + " UNION ALL ".join(
        f"SELECT _quarantine_table_name, _quarantine_reason, _quarantine_date FROM bad_{s}" for s in SHORT.values()
    )
    + ") GROUP BY ALL",
)
def _(spark, sf):
    needed = ["_quarantine_table_name", quality.REASON, "_quarantine_date"]
    return quality.quarantine_report(union_by_name(*[quarantined(spark, sf, e).select(*needed) for e in ENTITIES]))


@register(
    "union_by_name",
    """SELECT order_id, order_item_id, CAST(NULL AS INTEGER) AS payment_sequential, price,
              CAST(NULL AS DOUBLE) AS payment_value FROM raw_items
       UNION ALL SELECT order_id, NULL, payment_sequential, NULL, payment_value FROM raw_payments""",
)
def _(spark, sf):
    items = raw(spark, sf, "order_items").select("price", "order_id", "order_item_id")
    payments = raw(spark, sf, "payments").select("payment_value", "payment_sequential", "order_id")
    return union_by_name(items, payments)
