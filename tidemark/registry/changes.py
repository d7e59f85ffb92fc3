"""Keyed state, change feeds and the change log, in batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES, OP
from tidemark.operators import changelog
from tidemark.operators.cdc import (
    apply_feed,
    change_feed,
    drop_preimages,
    latest_by_key,
    scd1_apply,
    union_by_name,
    version_order,
)
from tidemark.operators.ranking import numbered
from tidemark.plans import silver, star
from tidemark.plans.analyses import audit
from tidemark.registry.base import KEY_MODE, NOW, cleaned, current, raw, received, register
from tidemark.registry.sql import CTES, LOAD, SHORT
from tidemark.sources import testbed

MIDWAY = datetime(1998, 6, 30, 23, 59, 59)
MIDWAY_SQL = f"TIMESTAMP '{MIDWAY}'"
START = datetime(1995, 1, 1)
ITEM = ("order_id", "order_item_id")
ITEM_VALUES = ("product_id", "seller_id", "shipping_limit_date", "price", "freight_value")
ITEM_ROW = (*ITEM, *ITEM_VALUES, OP, COMMIT_TS)
ITEM_SQL = ", ".join([*ITEM, *ITEM_VALUES, f'"{OP}"', f'"{COMMIT_TS}"'])

_LAST = """SELECT * FROM (SELECT * FROM {source} QUALIFY row_number() OVER (
           PARTITION BY {keys} ORDER BY "AR_H_COMMIT_TIMESTAMP" DESC) = 1) WHERE "OP" <> 'D'"""
CTES |= {
    "items_midway": f"""SELECT {ITEM_SQL} FROM ({_LAST.format(
        source=f'(SELECT * FROM clean_items WHERE "{COMMIT_TS}" <= {MIDWAY_SQL})', keys='order_id, order_item_id')})""",
    "items_final": f"SELECT {ITEM_SQL} FROM silver_items",
    "items_feed": """
        SELECT * FROM (
            SELECT a.*, CASE WHEN b.order_id IS NULL THEN 'delete' ELSE 'update_preimage' END AS _change_type
            FROM items_midway a LEFT JOIN items_final b
            ON a.order_id = b.order_id AND a.order_item_id = b.order_item_id
            WHERE b.order_id IS NULL OR a IS DISTINCT FROM b
            UNION ALL
            SELECT b.*, CASE WHEN a.order_id IS NULL THEN 'insert' ELSE 'update_postimage' END
            FROM items_final b LEFT JOIN items_midway a
            ON a.order_id = b.order_id AND a.order_item_id = b.order_item_id
            WHERE a.order_id IS NULL OR a IS DISTINCT FROM b)""",
}


def items_at(spark, sf, moment=None):
    rows = cleaned(spark, sf, "order_items")
    if moment is not None:
        rows = rows.filter(F.col(COMMIT_TS) <= F.lit(str(moment)).cast("timestamp_ntz"))
    return scd1_apply(rows, ITEM, silver.silver_sequence(), silver.is_delete())


# -- state --------------------------------------------------------------------------------------------------------


@register("scd1_apply", _LAST.format(source="raw_items", keys="order_id, order_item_id"))
def _(spark, sf):
    return scd1_apply(raw(spark, sf, "order_items"), ITEM, F.col(COMMIT_TS), silver.is_delete())


@register("scd1_user_state", _LAST.format(source="user_changes", keys="user_id"))
def _(spark, sf):
    return scd1_apply(testbed.user_changes(spark, sf), ["user_id"], F.col(COMMIT_TS), silver.is_delete())


@register(
    "scd1_dedupe_in_batch",
    """SELECT *, CAST(year("AR_H_COMMIT_TIMESTAMP") AS INTEGER) AS batch FROM raw_items
       QUALIFY row_number() OVER (PARTITION BY year("AR_H_COMMIT_TIMESTAMP"), order_id, order_item_id
                                  ORDER BY "AR_H_COMMIT_TIMESTAMP" DESC) = 1""",
)
def _(spark, sf):
    rows = raw(spark, sf, "order_items").withColumn("batch", F.year(COMMIT_TS))
    return latest_by_key(rows, ["batch", *ITEM], version_order(rows, F.col(COMMIT_TS), silver.is_delete()))


@register("scd1_composite_key", _LAST.format(source="raw_reviews", keys="review_id, order_id"))
def _(spark, sf):
    keys = ENTITIES["reviews"].keys
    return scd1_apply(raw(spark, sf, "reviews"), keys, F.col(COMMIT_TS), silver.is_delete())


for _entity, _short in SHORT.items():
    if _entity != "product_category_name_translation":

        @register(f"silver_{_entity}", f"SELECT * FROM silver_{_short}")
        def _(spark, sf, entity=_entity):
            return current(spark, sf, entity)


@register("silver_translation", "SELECT * FROM silver_translation")
def _(spark, sf):
    return current(spark, sf, "product_category_name_translation")


@register(
    "bronze_history",
    """SELECT order_id, order_item_id, CAST(sum(b) AS BIGINT) AS bronze_versions, CAST(sum(s) AS BIGINT) AS silver_rows
       FROM (SELECT order_id, order_item_id, 1 AS b, 0 AS s FROM recv_items
             UNION ALL SELECT order_id, order_item_id, 0, 1 FROM silver_items) GROUP BY ALL""",
)
def _(spark, sf):
    key = F.struct(*ITEM)
    found = audit(
        key,
        bronze_versions=received(spark, sf, "order_items"),
        silver_rows=current(spark, sf, "order_items"),
    )
    return found.select("audit_key.*", "bronze_versions", "silver_rows")


# -- change feed --------------------------------------------------------------------------------------------------


@register("change_feed", "SELECT * FROM items_feed")
def _(spark, sf):
    before, after = items_at(spark, sf, MIDWAY), items_at(spark, sf)
    return change_feed(before.select(*ITEM_ROW), after.select(*ITEM_ROW), ITEM)


@register("drop_preimages", "SELECT * FROM items_feed WHERE _change_type <> 'update_preimage'")
def _(spark, sf):
    before, after = items_at(spark, sf, MIDWAY), items_at(spark, sf)
    return drop_preimages(change_feed(before.select(*ITEM_ROW), after.select(*ITEM_ROW), ITEM))


@register("propagate_changes", "SELECT * FROM fact_order_items")
def _(spark, sf):
    """The fact table as of midway, brought up to date by the feed alone."""
    before, after = items_at(spark, sf, MIDWAY), items_at(spark, sf)
    orders = star.dim_order(current(spark, sf, "orders"), None, NOW, KEY_MODE)
    feed = change_feed(before, after, ITEM, preimages=False)
    facts = star.fact_order_items(before, orders, NOW, KEY_MODE)
    return apply_feed(facts, star.fact_order_items(feed, orders, NOW, KEY_MODE), ITEM)


# -- change log ---------------------------------------------------------------------------------------------------

_ORDER_COMMIT = """CASE WHEN order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
                        THEN order_delivered_customer_date ELSE order_purchase_timestamp END"""
_COMMITS = {
    "orders": f"SELECT order_id AS k, {_ORDER_COMMIT} AS t FROM raw_orders",
    "order_items": """SELECT i.order_id || '/' || order_item_id AS k, order_purchase_timestamp AS t
                      FROM raw_items i LEFT JOIN raw_orders o ON i.order_id = o.order_id""",
    "payments": """SELECT p.order_id || '/' || payment_sequential AS k, order_purchase_timestamp AS t
                   FROM raw_payments p LEFT JOIN raw_orders o ON p.order_id = o.order_id""",
    "reviews": "SELECT review_id || '/' || order_id AS k, CAST(review_creation_date AS TIMESTAMP) AS t FROM raw_reviews",
    "customers": f"""SELECT c.customer_id AS k, min({_ORDER_COMMIT}) AS t
                     FROM raw_customers c LEFT JOIN raw_orders o ON c.customer_id = o.customer_id GROUP BY c.customer_id""",
    "products": """SELECT p.product_id AS k, min(order_purchase_timestamp) AS t FROM raw_products p
                   LEFT JOIN raw_items i ON p.product_id = i.product_id
                   LEFT JOIN raw_orders o ON i.order_id = o.order_id GROUP BY p.product_id""",
    "sellers": """SELECT s.seller_id AS k, min(order_purchase_timestamp) AS t FROM raw_sellers s
                  LEFT JOIN raw_items i ON s.seller_id = i.seller_id
                  LEFT JOIN raw_orders o ON i.order_id = o.order_id GROUP BY s.seller_id""",
    "product_category_name_translation": f"SELECT product_category_name AS k, {LOAD} AS t FROM raw_translation",
}
CTES["commits"] = " UNION ALL ".join(f"SELECT '{n}' AS table_name, k AS row_key, t AS commit_ts FROM ({s})" for n, s in _COMMITS.items())


def committed(spark, sf):
    """The eight entities with commit times derived from their rows and relations."""
    tables = {e: raw(spark, sf, e) for e in ENTITIES}
    return changelog.commit_timestamps(tables, testbed.LOAD_TS)


@register("commit_timestamp", "SELECT * FROM commits")
def _(spark, sf):
    parts = []
    for name, df in committed(spark, sf).items():
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in ENTITIES[name].keys])
        parts.append(df.select(F.lit(name).alias("table_name"), key.alias("row_key"), F.col(COMMIT_TS).alias("commit_ts")))
    return union_by_name(*parts)


@register(
    "min_commit_per_key",
    """SELECT 'product_id' AS kind, product_id AS id, min("AR_H_COMMIT_TIMESTAMP") AS first_commit FROM raw_items
       GROUP BY product_id
       UNION ALL SELECT 'seller_id', seller_id, min("AR_H_COMMIT_TIMESTAMP") FROM raw_items GROUP BY seller_id
       UNION ALL SELECT 'customer_id', customer_id, min("AR_H_COMMIT_TIMESTAMP") FROM raw_orders GROUP BY customer_id""",
)
def _(spark, sf):
    parts = []
    for key, entity in (("product_id", "order_items"), ("seller_id", "order_items"), ("customer_id", "orders")):
        first = changelog.min_commit_per_key(raw(spark, sf, entity), key)
        parts.append(first.select(F.lit(key).alias("kind"), F.col(key).alias("id"), F.col(COMMIT_TS).alias("first_commit")))
    return union_by_name(*parts)


@register(
    "split_full_load",
    f"""SELECT order_id, 'I' AS "OP", 'full' AS part, "AR_H_COMMIT_TIMESTAMP" FROM raw_orders
        WHERE "AR_H_COMMIT_TIMESTAMP" <= {MIDWAY_SQL}
        UNION ALL SELECT order_id, "OP", 'later', "AR_H_COMMIT_TIMESTAMP" FROM raw_orders
        WHERE "AR_H_COMMIT_TIMESTAMP" > {MIDWAY_SQL}
        UNION ALL SELECT order_id, 'I', 'full', "AR_H_COMMIT_TIMESTAMP" FROM raw_items
        WHERE "AR_H_COMMIT_TIMESTAMP" <= {MIDWAY_SQL}
        UNION ALL SELECT order_id, "OP", 'later', "AR_H_COMMIT_TIMESTAMP" FROM raw_items
        WHERE "AR_H_COMMIT_TIMESTAMP" > {MIDWAY_SQL}""",
)
def _(spark, sf):
    parts = []
    for entity in ("orders", "order_items"):
        full, later = changelog.split_full_load(raw(spark, sf, entity), MIDWAY)
        for name, df in (("full", full), ("later", later)):
            parts.append(df.select("order_id", OP, F.lit(name).alias("part"), COMMIT_TS))
    return union_by_name(*parts)


def _windowed_sql(source, start, hours, days):
    index = f"CAST(floor(date_diff('second', TIMESTAMP '{start}', \"{COMMIT_TS}\") / {hours * 3600}.0) AS INTEGER)"
    edge = f"TIMESTAMP '{start}' + to_hours({hours} * (window_index{{}}))"
    return f"""SELECT *, {edge.format('')} AS window_start, {edge.format(' + 1')} AS window_end
               FROM (SELECT *, {index} AS window_index FROM {source})
               WHERE "{COMMIT_TS}" >= TIMESTAMP '{start}' AND window_index < {int(days * 24 // hours)}"""


AFTER_MIDWAY = datetime(1998, 7, 1)
WEEK, ALL_DAYS = 168, 2660
CTES["week_orders"] = _windowed_sql("raw_orders", START, WEEK, ALL_DAYS)
CTES["week_items"] = _windowed_sql("raw_items", START, WEEK, ALL_DAYS)
CTES["week_payments"] = _windowed_sql("raw_payments", START, WEEK, ALL_DAYS)
CAPTURED = ("orders", "order_items", "payments")


def weekly(spark, sf):
    """Weeks of the whole history, for the tables that have one."""
    return {e: changelog.capture_windows(raw(spark, sf, e), START, WEEK, ALL_DAYS) for e in CAPTURED}


@register("capture_windows", _windowed_sql("raw_items", START, 6, ALL_DAYS))
def _(spark, sf):
    return changelog.capture_windows(raw(spark, sf, "order_items"), START, 6, ALL_DAYS)


@register("capture_windows_two_weeks", _windowed_sql("raw_orders", AFTER_MIDWAY, 6, 14))
def _(spark, sf):
    return changelog.capture_windows(raw(spark, sf, "orders"), AFTER_MIDWAY)


@register(
    "stamp_op",
    """SELECT order_id, order_status,
              CASE WHEN "OP" = 'D' THEN 'D' WHEN order_status <> 'created' THEN 'U' ELSE 'I' END AS "OP" FROM raw_orders
       UNION ALL SELECT order_id, NULL, 'I' FROM raw_items""",
)
def _(spark, sf):
    orders = changelog.stamp_op(raw(spark, sf, "orders"), "orders").select("order_id", "order_status", OP)
    items = changelog.stamp_op(raw(spark, sf, "order_items"), "order_items").select("order_id", OP)
    return union_by_name(orders, items)


@register(
    "chunk_rows",
    """SELECT order_id, order_item_id, "AR_H_COMMIT_TIMESTAMP", window_start, n AS row_in_window,
              CAST(floor((n - 1) / 100.0) + 1 AS INTEGER) AS chunk_index
       FROM (SELECT *, row_number() OVER (PARTITION BY window_start
                 ORDER BY "AR_H_COMMIT_TIMESTAMP", order_id, order_item_id) AS n FROM week_items)""",
)
def _(spark, sf):
    rows = weekly(spark, sf)["order_items"].select(*ITEM, COMMIT_TS, "window_start")
    return changelog.chunk_rows(rows, ITEM)


_PER_WEEK = " UNION ALL ".join(
    f"SELECT '{e}' AS table_name, window_start, count(*) AS n FROM week_{SHORT[e]} GROUP BY window_start" for e in CAPTURED
)


@register(
    "total_chunks",
    f"SELECT window_start, CAST(ceil(max(n) / 100.0) AS INTEGER) AS total_chunks FROM ({_PER_WEEK}) GROUP BY window_start",
)
def _(spark, sf):
    return changelog.total_chunks(weekly(spark, sf))


@register(
    "capture_manifest",
    f"""SELECT window_start, CAST(c AS INTEGER) AS chunk_index, table_name, least(100, n - (c - 1) * 100) AS rows
        FROM (SELECT *, unnest(range(1, CAST(ceil(n / 100.0) AS BIGINT) + 1)) AS c FROM ({_PER_WEEK}))""",
)
def _(spark, sf):
    return changelog.chunk_manifest(weekly(spark, sf))


@register(
    "capture_check",
    " UNION ALL ".join(
        f"""SELECT '{e}' AS table_name, (SELECT count(*) FROM raw_{SHORT[e]}) AS source_rows,
                   (SELECT count(*) FROM raw_{SHORT[e]} WHERE "{COMMIT_TS}" IS NULL) AS rows_without_commit,
                   (SELECT count(*) FROM week_{SHORT[e]}) AS captured_rows,
                   (SELECT count(*) FROM (SELECT 1 FROM week_{SHORT[e]} GROUP BY {', '.join(ENTITIES[e].keys)}
                                          HAVING count(*) > 1)) AS repeated_keys"""
        for e in CAPTURED
    ),
)
def _(spark, sf):
    return changelog.capture_check(weekly(spark, sf), {e: raw(spark, sf, e) for e in CAPTURED})


@register(
    "sort_by_commit",
    """SELECT order_id, order_item_id, "AR_H_COMMIT_TIMESTAMP",
              row_number() OVER (ORDER BY "AR_H_COMMIT_TIMESTAMP", order_id, order_item_id) AS commit_rank FROM raw_items""",
)
def _(spark, sf):
    rows = raw(spark, sf, "order_items").select(*ITEM, COMMIT_TS)
    return numbered(rows, [COMMIT_TS, *ITEM], name="commit_rank")
