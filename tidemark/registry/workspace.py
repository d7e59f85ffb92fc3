"""Stored inputs of the table and streaming queries: landed test data and warehouses built from it.

Each is written once per session and test-data folder, under the shared folder, and then only read.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES
from tidemark.plans import silver
from tidemark.plans.medallion import Warehouse, store_star
from tidemark.registry.base import KEY_MODE, NOW, cleaned, current, gold, raw
from tidemark.registry.changes import ITEM, MIDWAY
from tidemark.session import scratch
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.landing import write_landing

FOLLOWED = ("items_by_month", "items", "customers", "reviews", "deliveries")  # measures the runs keep current
EARLY_SELLER = "cast(substr(seller_id, 2) as bigint) % 2 = 0"
SIDE_BY_SIDE = 4  # entities that land at a time
FIRST_DAY = date(2001, 9, 1)  # everything committed before lands as one initial load
_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build(scratch(spark, name))
    return _built[key]


def early(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col(COMMIT_TS) <= F.lit(str(MIDWAY)).cast("timestamp_ntz"), F.lit(True)))


def late(df: DataFrame) -> DataFrame:
    return df.filter(F.col(COMMIT_TS) > F.lit(str(MIDWAY)).cast("timestamp_ntz"))


def land(root: str, parts: dict[str, DataFrame]) -> None:
    """Write change rows of several entities to day folders, side by side: small ones do not wait for large ones."""
    write = inheritable_thread_target(next(iter(parts.values())).sparkSession)(lambda e: write_landing(parts[e], root, e, FIRST_DAY))
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        list(pool.map(write, parts))


def landing(spark: SparkSession, sf_dir: str, entity: str) -> str:
    """One entity in day folders: the folder that holds it. A query lands the entities it reads, each once a session."""

    def build(root: str) -> str:
        land(root, {entity: raw(spark, sf_dir, entity)})
        return root

    return once(spark, sf_dir, f"landing-{entity}", build)


def item_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """Current order items in two versions: up to midway, and all."""

    def build(root: str) -> KeyedTable:
        table = KeyedTable(spark, root, ITEM)
        rows = cleaned(spark, sf_dir, "order_items")
        for part in (early(rows), late(rows)):
            table.merge(part, silver.silver_sequence(), silver.is_delete())
        return table

    return once(spark, sf_dir, "items", build)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star schema after two runs: items and reviews first without their later orders, then the rest."""

    def build(root: str) -> Warehouse:
        landed, house = f"{root}/landing", Warehouse(spark, f"{root}/tables", mode=KEY_MODE, live=FOLLOWED)
        rows = {entity: raw(spark, sf_dir, entity) for entity in ENTITIES}
        land(landed, rows | {"orders": early(rows["orders"])})
        house.run(landed, NOW)
        land(landed, {"orders": late(rows["orders"])})
        house.run(landed, NOW)
        return house

    return once(spark, sf_dir, "warehouse", build)


def checked_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Two runs in which items must have an order and members may come late: first the earlier orders and every second seller, then the rest."""

    def build(root: str) -> Warehouse:
        landed = f"{root}/landing"
        house = Warehouse(spark, f"{root}/tables", mode=KEY_MODE, checked=("order_items",), inferred=True)
        entities = ("customers", "sellers", "products", "product_category_name_translation", "orders", "order_items")
        orders, sellers = raw(spark, sf_dir, "orders"), raw(spark, sf_dir, "sellers")
        parts = {"orders": (early(orders), late(orders)), "sellers": (sellers.filter(EARLY_SELLER), sellers.filter(f"not ({EARLY_SELLER})"))}
        land(landed, {e: parts[e][0] if e in parts else raw(spark, sf_dir, e) for e in entities})
        house.run(landed, NOW, entities)
        land(landed, {e: rest for e, (_, rest) in parts.items()})
        house.run(landed, NOW, entities)
        return house

    return once(spark, sf_dir, "checked-warehouse", build)


def stored_star(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The gold tables as a run leaves them behind, for queries that read several of them; all, or those that a query names."""

    def build(root: str) -> dict[str, DataFrame]:
        rows = cache(lambda entity: current(spark, sf_dir, entity))
        return store_star(spark, gold(spark, sf_dir), rows, root, names, now=NOW, mode=KEY_MODE)

    return once(spark, sf_dir, "-".join(("star", *names)), build)
