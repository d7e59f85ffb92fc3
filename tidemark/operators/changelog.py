"""A change log from plain tables: commit times, initial load, capture windows and chunks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES, OP
from tidemark.operators.ranking import numbered

# Fixed values of the capture: window length, rows per chunk, days captured.
WINDOW_HOURS = 6
CHUNK_ROWS = 100
CAPTURE_DAYS = 14


def order_commit() -> Column:
    """Delivery time of a delivered order when known, else its purchase."""
    done = (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    return F.when(done, F.col("order_delivered_customer_date")).otherwise(F.col("order_purchase_timestamp"))


def min_commit_per_key(changes: DataFrame, key: str) -> DataFrame:
    """Earliest commit of every key."""
    return changes.groupBy(key).agg(F.min(COMMIT_TS).alias(COMMIT_TS))


def commit_timestamps(tables: Mapping[str, DataFrame], load_time: datetime | str) -> dict[str, DataFrame]:
    """The eight entities with a commit time each, from times in their rows or in the rows that refer to them.

    Customers take the first commit of their orders, products and sellers that of their items; those never ordered
    keep NULL.
    """
    bare = {n: df.drop(OP, COMMIT_TS) for n, df in tables.items()}
    orders = bare["orders"].withColumn(COMMIT_TS, order_commit())
    bought = bare["orders"].select("order_id", F.col("order_purchase_timestamp").alias(COMMIT_TS))
    items = bare["order_items"].join(bought, "order_id", "left")
    return {
        "orders": orders,
        "order_items": items,
        "payments": bare["payments"].join(bought, "order_id", "left"),
        "reviews": bare["reviews"].withColumn(COMMIT_TS, F.col("review_creation_date").cast("timestamp_ntz")),
        "customers": bare["customers"].join(min_commit_per_key(orders, "customer_id"), "customer_id", "left"),
        "products": bare["products"].join(min_commit_per_key(items, "product_id"), "product_id", "left"),
        "sellers": bare["sellers"].join(min_commit_per_key(items, "seller_id"), "seller_id", "left"),
        "product_category_name_translation": bare["product_category_name_translation"].withColumn(
            COMMIT_TS, F.lit(load_time).cast("timestamp_ntz")
        ),
    }


def split_full_load(df: DataFrame, cutoff: datetime | str) -> tuple[DataFrame, DataFrame]:
    """The initial load (all inserts) up to the cutoff, and what was committed later; rows of no time are in neither."""
    moment = F.lit(str(cutoff)).cast("timestamp_ntz")
    return df.filter(F.col(COMMIT_TS) <= moment).withColumn(OP, F.lit("I")), df.filter(F.col(COMMIT_TS) > moment)


def capture_windows(
    df: DataFrame, start: datetime, hours: int = WINDOW_HOURS, days: float = CAPTURE_DAYS
) -> DataFrame:
    """Rows committed within the capture, with their half-open window [start, end)."""
    span = hours * 3600
    total = int(days * 24 // hours)
    first = F.lit(str(start)).cast("timestamp_ntz")
    index = F.floor(F.timestamp_diff("SECOND", first, F.col(COMMIT_TS)) / F.lit(span)).cast("int")
    inside = (F.col(COMMIT_TS) >= first) & (F.col("window_index") < total)

    def edge(i: Column) -> Column:
        return F.timestamp_add("SECOND", (i * span).cast("int"), first)

    return (
        df.withColumn("window_index", index)
        .filter(inside)
        .withColumns({"window_start": edge(F.col("window_index")), "window_end": edge(F.col("window_index") + 1)})
    )


def stamp_op(df: DataFrame, entity: str) -> DataFrame:
    """Operation of captured rows: orders past creation count as updates, other tables only insert; deletes stay."""
    if entity != "orders":
        return df.withColumn(OP, F.lit("I"))
    moved_on = F.col("order_status").isNull() | (F.col("order_status") != "created")
    op = F.when(F.col(OP).eqNullSafe("D"), "D").when(moved_on, "U").otherwise("I")
    return df.withColumn(OP, op)


def chunk_rows(
    captured: DataFrame, order: Sequence[str], size: int = CHUNK_ROWS, group: Sequence[str] = ("window_start",)
) -> DataFrame:
    """Number the rows of each window by commit time and cut them into chunks 1.. of ``size`` rows."""
    ranked = numbered(captured, [COMMIT_TS, *order], group, "row_in_window")
    return ranked.withColumn("chunk_index", (F.floor((F.col("row_in_window") - 1) / size) + 1).cast("int"))


def total_chunks(tables: Mapping[str, DataFrame], size: int = CHUNK_ROWS) -> DataFrame:
    """Chunks per window: as many as its fullest table needs."""
    counts = [
        df.groupBy("window_start").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(n))
        for n, df in tables.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b), counts)
    return stacked.groupBy("window_start").agg(F.ceil(F.max("rows") / size).cast("int").alias("total_chunks"))


def chunk_manifest(tables: Mapping[str, DataFrame], size: int = CHUNK_ROWS) -> DataFrame:
    """Rows per window, chunk and table; empty ones have no line.

    Chunk sizes follow from the number of rows in a window, so nothing needs to be ranked.
    """
    counts = [
        df.groupBy("window_start").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(n))
        for n, df in tables.items()
    ]
    per_window = reduce(lambda a, b: a.unionByName(b), counts)
    chunks = F.explode(F.sequence(F.lit(1), F.ceil(F.col("rows") / size).cast("int")))
    return per_window.select("window_start", "table_name", "rows", chunks.alias("chunk_index")).select(
        "window_start",
        "chunk_index",
        "table_name",
        F.least(F.lit(size), F.col("rows") - (F.col("chunk_index") - 1) * size).cast("bigint").alias("rows"),
    )


def capture_check(tables: Mapping[str, DataFrame], source: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows in the source, rows without commit time, rows captured, keys captured more than once."""
    parts = []
    for name, df in tables.items():
        keys = list(ENTITIES[name].keys)
        by_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        seen = by_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("captured_rows"), F.count_if(F.col("n") > 1).alias("repeated_keys")
        )
        total = source[name].agg(
            F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col(COMMIT_TS).isNull()).alias("rows_without_commit")
        )
        parts.append(seen.withColumn("table_name", F.lit(name)))
        parts.append(total.withColumn("table_name", F.lit(name)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = ("source_rows", "rows_without_commit", "captured_rows", "repeated_keys")
    return stacked.groupBy("table_name").agg(*[F.max(v).alias(v) for v in values])
