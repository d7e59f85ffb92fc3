"""Streaming steps run to completion; each must end where the batch computation does."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES, OP
from tidemark.operators.cdc import inferred_members, resolve_members
from tidemark.plans import silver, star
from tidemark.registry.base import KEY_MODE, NOW, current, gold, raw, register
from tidemark.registry.changes import ITEM, ITEM_ROW, ITEM_SQL
from tidemark.registry.sql import SHORT
from tidemark.registry.tables import DAY_SQL
from tidemark.registry.workspace import FIRST_DAY, early, landing, late, once, warehouse
from tidemark.session import scratch
from tidemark.sources import testbed
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.landing import STORED_AS, landing_stream, write_landing
from tidemark.streaming import runs
from tidemark.streaming.keyed_state import living_rows, settle


def bronze(spark, sf, entities=tuple(ENTITIES)):
    """Bronze tables of all entities, or of those a query reads, fed side by side."""

    def build(root):
        started = [runs.bronze_append(spark, landing(spark, sf, e), root, e, NOW) for e in entities]
        runs.run_all(started)
        return root

    return once(spark, sf, "-".join(("bronze", *entities)), build)


@register("landing_stream", f"SELECT {ITEM_SQL} FROM raw_items")
def _(spark, sf):
    root = scratch(spark, "landing-stream")
    stream = landing_stream(spark, landing(spark, sf, "order_items"), "order_items").select(*ITEM_ROW)
    runs.append(stream, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@register(
    "bronze_append",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, year, month, day, count(*) AS rows FROM (SELECT {DAY_SQL} FROM raw_{s}) GROUP BY ALL"
        for e, s in SHORT.items()
    ),
)
def _(spark, sf):
    root, parts = bronze(spark, sf), None
    for e in ENTITIES:
        days = runs.read_bronze(spark, root, e).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))
        days = days.withColumn("table_name", F.lit(e))
        parts = days if parts is None else parts.unionByName(days)
    return parts


@register("resume_from_checkpoint", f"SELECT {ITEM_SQL} FROM raw_items")
def _(spark, sf):
    """Three runs over a growing landing folder: each row arrives once."""
    root = scratch(spark, "resumed")
    items = raw(spark, sf, "order_items")
    write_landing(early(items), f"{root}/landing", "order_items", FIRST_DAY)
    runs.bronze_append(spark, f"{root}/landing", f"{root}/bronze", "order_items", NOW).awaitTermination()
    write_landing(late(items), f"{root}/landing", "order_items", FIRST_DAY)
    for _ in range(2):
        runs.bronze_append(spark, f"{root}/landing", f"{root}/bronze", "order_items", NOW).awaitTermination()
    return runs.read_bronze(spark, f"{root}/bronze", "order_items").select(*ITEM_ROW)


@register(
    "read_stream",
    """SELECT 'first' AS consumer, order_id, payment_sequential, payment_value FROM raw_payments
       UNION ALL SELECT 'second', order_id, payment_sequential, payment_value FROM raw_payments""",
)
def _(spark, sf):
    """Two consumers of one append table, each with its own position."""
    root, source = scratch(spark, "consumers"), bronze(spark, sf, ("payments",))
    started = []
    for consumer in ("first", "second"):
        rows = runs.read_stream(spark, source, "payments").select("order_id", "payment_sequential", "payment_value")
        started.append(runs.append(rows, f"{root}/rows/consumer={consumer}", f"{root}/checkpoint-{consumer}"))
    runs.run_all(started)
    return spark.read.parquet(f"{root}/rows")


def _item_stream(spark, sf, name, parts, max_files=None, replays=1):
    """Land the given parts one after the other and keep a keyed table current from the stream."""
    root = scratch(spark, name)
    table = KeyedTable(spark, f"{root}/items", ITEM)
    for part in parts:
        write_landing(part, f"{root}/landing", "order_items", FIRST_DAY)
        for _ in range(replays):
            source = runs.bronze_append(spark, f"{root}/landing", f"{root}/bronze", "order_items", NOW, max_files)
            source.awaitTermination()
            stream = runs.read_stream(spark, f"{root}/bronze", "order_items", max_files)
            runs.silver_stream(
                stream, "order_items", table, f"{root}/quarantine", f"{root}/checkpoint", NOW
            ).awaitTermination()
    return root, table


@register("scd1_stream", f"SELECT {ITEM_SQL} FROM silver_items")
def _(spark, sf):
    items = raw(spark, sf, "order_items")
    _, table = _item_stream(spark, sf, "scd1", [early(items), late(items)])
    return table.read().select(*ITEM_ROW)


@register("scd1_out_of_order", f"SELECT {ITEM_SQL} FROM silver_items")
def _(spark, sf):
    """The newest changes arrive first, the oldest last."""
    items = raw(spark, sf, "order_items")
    _, table = _item_stream(spark, sf, "reordered", [late(items), early(items)])
    return table.read().select(*ITEM_ROW)


@register("micro_batch_files", f"SELECT {ITEM_SQL} FROM silver_items")
def _(spark, sf):
    """Small micro-batches of a few files each."""
    _, table = _item_stream(spark, sf, "small-batches", [raw(spark, sf, "order_items")], max_files=25)
    return table.read().select(*ITEM_ROW)


@register("idempotent_replay", f"SELECT {ITEM_SQL} FROM silver_items")
def _(spark, sf):
    """The same files delivered twice, and every run repeated."""
    items = raw(spark, sf, "order_items")
    _, table = _item_stream(spark, sf, "replayed", [items, items], replays=2)
    return table.read().select(*ITEM_ROW)


@register(
    "scd1_tombstone",
    """SELECT * FROM (SELECT * FROM user_changes QUALIFY row_number() OVER (
           PARTITION BY user_id ORDER BY "AR_H_COMMIT_TIMESTAMP" DESC) = 1) WHERE "OP" <> 'D'""",
)
def _(spark, sf):
    """All deletes first, then every older and newer row: older ones must not revive a key."""
    changes = testbed.user_changes(spark, sf)
    table = KeyedTable(spark, scratch(spark, "tombstones"), ["user_id"])
    for part in (changes.filter(silver.is_delete()), changes.filter(~silver.is_delete())):
        table.merge(part, F.col(COMMIT_TS), silver.is_delete())
    return table.read()


@register(
    "silver_quarantine_stream",
    """SELECT order_id, order_item_id, price, _quarantine_reason, _quarantine_table_name FROM bad_items""",
)
def _(spark, sf):
    items = raw(spark, sf, "order_items")
    root, _ = _item_stream(spark, sf, "quarantine", [early(items), late(items)])
    kept = spark.read.option("mergeSchema", True).parquet(f"{root}/quarantine")
    return kept.select(*ITEM, "price", "_quarantine_reason", "_quarantine_table_name")


FACT_COLUMNS = (
    "order_item_sk",
    "order_sk",
    "product_sk",
    "seller_sk",
    "customer_sk",
    "purchase_date_sk",
    *ITEM,
    "price",
    "freight_value",
    "gmv_item",
    OP,
    COMMIT_TS,
)
_FACT_SQL = ", ".join(f'"{c}"' for c in FACT_COLUMNS)


@register("triggered_run", f"SELECT {_FACT_SQL} FROM fact_order_items")
def _(spark, sf):
    """Landing files to facts in two runs, the second bringing orders the first one lacked."""
    return warehouse(spark, sf).star()["fact_order_items"].select(*FACT_COLUMNS)


@register(
    "triggered_run_orders",
    """SELECT order_sk, customer_sk, purchase_date_sk, order_id, order_status, delivery_days, estimated_days,
              delivery_delta_days, is_on_time, is_delivered FROM dim_order""",
)
def _(spark, sf):
    return warehouse(spark, sf).star()["dim_order"].select(
        "order_sk",
        "customer_sk",
        "purchase_date_sk",
        "order_id",
        "order_status",
        "delivery_days",
        "estimated_days",
        "delivery_delta_days",
        "is_on_time",
        "is_delivered",
    )


_ACCEPTED = """
    WITH c AS (
        SELECT order_id, order_status, order_purchase_timestamp AS bought, "OP" AS op, 0 AS later FROM raw_orders
        UNION ALL SELECT order_id, 'delivered', order_purchase_timestamp, 'U', 1 FROM raw_orders WHERE {updated}
        UNION ALL SELECT order_id, order_status, order_purchase_timestamp, 'D', 1 FROM raw_orders WHERE {deleted})
    SELECT order_id, order_status FROM (
        SELECT * FROM c
        WHERE op = 'D' OR (bought IS NOT NULL AND order_status IN ('delivered', 'shipped', 'canceled', 'unavailable',
                           'invoiced', 'processing', 'created', 'approved'))
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY later DESC) = 1)
    WHERE op <> 'D'"""
_UPDATED, _DELETED = "CAST(substr(order_id, 2) AS BIGINT) % 10 = 1", "CAST(substr(order_id, 2) AS BIGINT) % 10 = 2"


@register("order_updates_and_deletes", _ACCEPTED.format(updated=_UPDATED, deleted=_DELETED))
def _(spark, sf):
    """One order in ten is delivered a day later, and one in ten deleted; both arrive in a second delivery."""
    root, orders = scratch(spark, "order-changes"), raw(spark, sf, "orders")
    later = F.lit("9999-01-01").cast("timestamp_ntz")
    updates = orders.filter(_UPDATED).withColumns({"order_status": F.lit("delivered"), OP: F.lit("U"), COMMIT_TS: later})
    deletes = orders.filter(_DELETED).withColumns({OP: F.lit("D"), COMMIT_TS: later})
    table = KeyedTable(spark, f"{root}/orders", ["order_id"])
    for part in (orders, updates.unionByName(deletes)):
        clean = silver.clean(part.withColumn("_ingested_at", F.lit(str(NOW)).cast("timestamp_ntz")), "orders", NOW)
        table.merge(clean, silver.silver_sequence(), silver.is_delete())
    return table.read().select("order_id", "order_status")


@register("late_fact_repair", "SELECT review_sk, order_sk, purchase_date_sk, review_id, order_id, review_score FROM fact_reviews")
def _(spark, sf):
    """Facts staged while only the earlier orders were known, repaired once the others are."""
    orders = star.dim_order(current(spark, sf, "orders"), None, NOW, KEY_MODE)
    known = early(orders)
    facts = star.fact_reviews(current(spark, sf, "reviews"), known, NOW, KEY_MODE)
    repaired = star.repair_order_keys(facts, orders)
    return repaired.select("review_sk", "order_sk", "purchase_date_sk", "review_id", "order_id", "review_score")


@register(
    "stream_static_snapshot",
    "SELECT product_sk, product_id, product_category_name, product_category_name_english FROM dim_product",
)
def _(spark, sf):
    """A product stream beside one stored version of the translations."""
    root = scratch(spark, "snapshot")
    current(spark, sf, "product_category_name_translation").write.parquet(f"{root}/names")
    names = spark.read.parquet(f"{root}/names")
    clean = silver.clean(runs.read_stream(spark, bronze(spark, sf, ("products",)), "products").drop("_source_file_path"), "products", NOW)
    staged = star.dim_product(clean, names, NOW, KEY_MODE)
    columns = ("product_sk", "product_id", "product_category_name", "product_category_name_english")
    runs.append(staged.select(*columns), f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/rows")


@register("resolved_members", "SELECT order_id, order_status, false AS _is_inferred FROM silver_orders")
def _(spark, sf):
    """Placeholders for orders only the payments know, replaced when the orders arrive."""
    orders = gold(spark, sf)["dim_order"].select("order_id", "order_status", COMMIT_TS)
    known, arriving = early(orders).drop(COMMIT_TS), late(orders).drop(COMMIT_TS)
    payments = current(spark, sf, "payments").join(orders, "order_id", "left_semi")
    return resolve_members(inferred_members(payments, known, "order_id"), arriving, "order_id")


@register("scd1_state_stream", f"SELECT {ITEM_SQL} FROM silver_items")
def _(spark, sf):
    """Order items as the state of a stream, read back from its checkpoint; the later half of the changes comes first."""
    root = scratch(spark, "state")
    items = silver.clean(testbed.received(spark, sf, "order_items"), "order_items", NOW).select(*ITEM_ROW)
    for k, part in enumerate((late(items), early(items))):
        part.write.option("compression", STORED_AS).parquet(f"{root}/in/part={k}")
        stream = spark.readStream.schema(items.schema).parquet(f"{root}/in").select(*ITEM_ROW)
        settle(stream, ITEM, F.col(COMMIT_TS), silver.is_delete(), f"{root}/feed", f"{root}/checkpoint").awaitTermination()
    return living_rows(spark, f"{root}/checkpoint", items.schema)
