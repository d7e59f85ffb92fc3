"""Files, layouts and versioned tables: what is written must read back whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES
from tidemark.operators.cdc import evolve_schema
from tidemark.plans import silver, star
from tidemark.registry.base import KEY_MODE, NOW, cleaned, current, gold, quarantined, raw, register
from tidemark.registry.changes import ITEM, ITEM_ROW, ITEM_SQL
from tidemark.registry.sql import SHORT
from tidemark.registry.workspace import FIRST_DAY, early, item_table, landing, late, once
from tidemark.session import scratch
from tidemark.sources import files
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.landing import bronze_metadata, change_columns, read_landing, source_lineage
from tidemark.sources.layout import share_read, write_interleaved

LANDED = f"greatest(coalesce(CAST(\"{COMMIT_TS}\" AS DATE), DATE '{FIRST_DAY}'), DATE '{FIRST_DAY}')"
DAY_SQL = f"CAST(year({LANDED}) AS INTEGER) AS year, CAST(month({LANDED}) AS INTEGER) AS month, CAST(day({LANDED}) AS INTEGER) AS day"


@register("write_landing", f"SELECT {ITEM_SQL}, {DAY_SQL} FROM raw_items")
def _(spark, sf):
    return read_landing(spark, landing(spark, sf, "order_items"), "order_items").select(*ITEM_ROW, "year", "month", "day")


@register(
    "landing_partitions",
    " UNION ALL ".join(
        f"SELECT '{e}' AS table_name, year, month, day, count(*) AS rows FROM (SELECT {DAY_SQL} FROM raw_{s}) GROUP BY ALL"
        for e, s in (("orders", "orders"), ("order_items", "items"), ("reviews", "reviews"))
    ),
)
def _(spark, sf):
    parts = []
    for e in ("orders", "order_items", "reviews"):
        days = read_landing(spark, landing(spark, sf, e), e).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows"))
        parts.append(days.withColumn("table_name", F.lit(e)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "bronze_metadata",
    f"SELECT order_id, order_item_id, \"{COMMIT_TS}\", {LANDED} + INTERVAL '12 hours 34 minutes 56 seconds' AS _ingested_at FROM raw_items",
)
def _(spark, sf):
    rows = bronze_metadata(read_landing(spark, landing(spark, sf, "order_items"), "order_items"), NOW)
    return rows.select(*ITEM, COMMIT_TS, "_ingested_at")


@register(
    "source_lineage",
    f"SELECT year, month, day, count(*) AS rows, count(*) AS located_rows FROM (SELECT {DAY_SQL} FROM raw_items) GROUP BY ALL",
)
def _(spark, sf):
    rows = source_lineage(read_landing(spark, landing(spark, sf, "order_items"), "order_items"))
    folder = F.concat(
        *[x for c in ("year", "month", "day") for x in (F.lit(f"/{c}="), F.col(c).cast("string"))], F.lit("/")
    )
    located = F.col("_source_file_path").contains(folder)
    return rows.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(located).alias("located_rows")
    )


@register(
    "evolve_schema",
    """SELECT order_id, order_item_id, price, freight_value, product_id FROM raw_items WHERE price >= 1000
       UNION ALL SELECT order_id, order_item_id, price, NULL, NULL FROM raw_items WHERE price < 1000""",
)
def _(spark, sf):
    """Rows written before two columns were added upstream, beside rows written after."""
    items, root = raw(spark, sf, "order_items"), scratch(spark, "evolved")
    items.filter("price < 1000").select(*ITEM, "price").write.parquet(f"{root}/batch=1")
    items.filter("price >= 1000").select("product_id", "freight_value", "price", *ITEM).write.parquet(f"{root}/batch=2")
    merged = spark.read.option("mergeSchema", True).parquet(root).drop("batch")
    return evolve_schema(merged, items.select(*ITEM, "price", "freight_value"))


@register("read_entity_csv", f"SELECT * EXCLUDE (\"OP\", \"{COMMIT_TS}\") FROM raw_orders")
def _(spark, sf):
    path = scratch(spark, "orders-csv")
    files.write_entity_csv(raw(spark, sf, "orders").select(*ENTITIES["orders"].columns.fieldNames()), path)
    return files.read_entity_csv(spark, path, "orders")


@register("write_partitioned", "SELECT * FROM silver_customers")
def _(spark, sf):
    path = scratch(spark, "customers-by-state")
    rows = current(spark, sf, "customers")
    files.write_partitioned(rows, path, [ENTITIES["customers"].partition_by], ["customer_id"])
    return spark.read.schema(rows.schema).parquet(path)


def _layout(entity, spread):
    """The business layout of a silver table: one folder per value of the column reports filter on."""

    @register(f"write_partitioned_{SHORT[entity]}", f"SELECT * FROM silver_{SHORT[entity]}")
    def _(spark, sf):
        path = scratch(spark, f"{entity}-laid-out")
        rows = current(spark, sf, entity)
        files.write_partitioned(rows, path, [ENTITIES[entity].partition_by], [spread])
        return spark.read.schema(rows.schema).parquet(path)


for _entity, _spread in (("sellers", "seller_id"), ("products", "product_id"), ("orders", "order_id")):
    _layout(_entity, _spread)


@register(
    "write_partitioned_quarantine",
    """SELECT order_id, order_item_id, price, _quarantine_reason, _quarantine_table_name FROM bad_items""",
)
def _(spark, sf):
    path = scratch(spark, "quarantine-by-day")
    files.write_partitioned(quarantined(spark, sf, "order_items"), path, ["_quarantine_date"], ITEM)
    return spark.read.parquet(path).select(*ITEM, "price", "_quarantine_reason", "_quarantine_table_name")


@register("write_clustered", "SELECT * FROM fact_order_items")
def _(spark, sf):
    path, table = scratch(spark, "clustered"), star.GOLD["fact_order_items"]
    files.write_clustered(gold(spark, sf)["fact_order_items"], path, table.clustered_by)
    return spark.read.parquet(path)


LAID_OUT = 16


def interleaved_facts(spark, sf):
    """The items laid out by both columns that reports filter on."""

    def build(root):
        write_interleaved(gold(spark, sf)["fact_order_items"], root, star.GOLD["fact_order_items"].clustered_by, LAID_OUT)
        return root

    return once(spark, sf, "interleaved", build)


@register("write_interleaved", "SELECT * FROM fact_order_items")
def _(spark, sf):
    return spark.read.parquet(interleaved_facts(spark, sf))


@register(
    "interleaved_skipping",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, least({LAID_OUT}, count({c})) AS files, true AS under_a_third FROM fact_order_items"
        for c in star.GOLD["fact_order_items"].clustered_by
    ),
)
def _(spark, sf):
    """Whether a filter on either column reads under a third of the files."""
    path, parts = interleaved_facts(spark, sf), []
    for c in star.GOLD["fact_order_items"].clustered_by:
        found = share_read(spark, path, c)
        parts.append(found.select(F.lit(c).alias("column_name"), "files", (F.col("share") < 1 / 3).alias("under_a_third")))
    return parts[0].unionByName(parts[1])


@register("compact", f"SELECT {ITEM_SQL}, {DAY_SQL} FROM raw_items")
def _(spark, sf):
    path = scratch(spark, "compacted")
    files.compact(spark, f"{landing(spark, sf, 'order_items')}/order_items", path, ["year", "month", "day"])
    return spark.read.parquet(path).select(*ITEM_ROW, "year", "month", "day")


@register("materialize", "SELECT * FROM dim_date")
def _(spark, sf):
    root = scratch(spark, "dim_date")
    files.materialize(star.dim_date(early(current(spark, sf, "orders")), KEY_MODE), root, 1)
    return files.materialize(star.dim_date(current(spark, sf, "orders"), KEY_MODE), root, 2)


@register("read_snapshot", f"SELECT {ITEM_SQL} FROM silver_items")
def _(spark, sf):
    return item_table(spark, sf).read().select(*ITEM_ROW)


@register("read_version", "SELECT * FROM items_midway")
def _(spark, sf):
    return item_table(spark, sf).read(1).select(*ITEM_ROW)


@register(
    "read_changes",
    f"""SELECT {ITEM_SQL}, 'insert' AS _change_type, 1 AS _commit_version FROM items_midway
        UNION ALL
        SELECT {ITEM_SQL}, _change_type, 2 FROM items_feed""",
)
def _(spark, sf):
    feed = item_table(spark, sf).read_changes(1, 2, preimages=True)
    return feed.select(*ITEM_ROW, "_change_type", "_commit_version")


@register("rollback", "SELECT * FROM items_midway")
def _(spark, sf):
    """A table rolled back to its first version, then compacted."""
    table = KeyedTable(spark, scratch(spark, "rolled-back"), ITEM)
    rows = cleaned(spark, sf, "order_items")
    for part in (early(rows), late(rows)):
        table.merge(part, silver.silver_sequence(), silver.is_delete())
    table.rollback(1)
    table.compact()
    return table.read().select(*ITEM_ROW)


@register("change_columns", "SELECT * FROM raw_payments")
def _(spark, sf):
    return read_landing(spark, landing(spark, sf, "payments"), "payments").select(*change_columns("payments"))
