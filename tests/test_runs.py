"""The acceptance scenarios, run through landing, bronze, silver and gold."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set, item, order, rows, ts
from tidemark.entities import ENTITIES
from tidemark.plans.medallion import Warehouse, build_star
from tidemark.sources.folders import remove
from tidemark.sources.landing import added_columns, read_landing, write_landing
from tidemark.streaming import runs

NOW = datetime(2024, 5, 6, 7, 8, 9)
FIRST = date(2018, 8, 5)

REST = {
    "customers": [{"customer_id": "c-x", "customer_unique_id": "u", "customer_state": "SP", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}],
    "sellers": [{"seller_id": "s1", "seller_state": "SP", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}],
    "products": [{"product_id": "p1", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}],
    "product_category_name_translation": [
        {"product_category_name": "automotivo", "product_category_name_english": "auto", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}
    ],
    "payments": [
        {"order_id": "x", "payment_sequential": 1, "payment_type": "boleto", "payment_installments": 1, "payment_value": 1.0, "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}
    ],
    "reviews": [{"review_id": "r", "order_id": "x", "review_score": 5, "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-04")}],
}


def land(spark, root, **tables):
    for entity, data in tables.items():
        write_landing(rows(spark, entity, *data).drop("_ingested_at"), root, entity, FIRST)


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("house"))
    house = Warehouse(spark, f"{root}/tables")
    land(
        spark,
        f"{root}/landing",
        orders=[order("x"), order("y"), order("z")],
        order_items=[item("x"), item("y"), item("w", 1), item("z", 1)],
        **REST,
    )
    house.run(f"{root}/landing", NOW)
    land(
        spark,
        f"{root}/landing",
        orders=[
            order("x", "D", "2018-08-06 12:49:18"),
            order("y", "U", "2018-08-08 08:18:08", status="delivered", order_delivered_customer_date=ts("2018-08-08 08:18:08")),
            {"customer_id": "c", "order_status": "created", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-07 08:00:18")},
            order("w", "U", "2018-08-07 00:00:00"),
        ],
        order_items=[item("bad", 0, -99.99, None, at="2018-08-09 09:00:38"), item("z", 1, op="D", at="2018-08-09 10:00:00")],
    )
    house.run(f"{root}/landing", NOW)
    return house


def count(df, order_id):
    return df.filter(F.col("order_id") == order_id).count()


def test_a_deleted_order_leaves_silver_and_gold(spark, house):
    bronze = runs.read_bronze(spark, f"{house.root}/bronze", "orders")
    assert as_set(bronze.filter("order_id = 'x'"), "OP") == {("I",), ("D",)}
    assert count(house.silver_table("orders").read(), "x") == 0
    assert count(house.gold_table("dim_order").read(), "x") == 0


def test_an_updated_order_has_its_last_status(spark, house):
    assert count(runs.read_bronze(spark, f"{house.root}/bronze", "orders"), "y") == 2
    for table in (house.silver_table("orders"), house.gold_table("dim_order")):
        assert as_set(table.read().filter("order_id = 'y'"), "order_status") == {("delivered",)}


def test_rejected_rows_are_in_quarantine(house):
    assert as_set(house.quarantine("orders"), "_quarantine_reason") == {("null_purchase_timestamp",)}
    assert as_set(house.quarantine("order_items"), "order_id", "_quarantine_reason") == {("bad", "negative_price")}


def test_an_update_of_an_unknown_order_inserts_it(house):
    assert count(house.silver_table("orders").read(), "w") == 1


def test_a_fact_gets_its_late_order(house):
    fact = house.gold_table("fact_order_items").read().filter("order_id = 'w'").first()
    assert fact.order_sk is not None and fact.purchase_date_sk is not None


def test_deleted_items_leave_the_facts(house):
    assert count(house.gold_table("fact_order_items").read(), "z") == 0


def test_facts_of_a_deleted_order_stay_without_its_keys(house):
    fact = house.gold_table("fact_order_items").read().filter("order_id = 'x'").collect()
    assert len(fact) == 1 and fact[0].order_sk is None and fact[0].purchase_date_sk is None


def test_a_run_without_new_files_changes_nothing(spark, house):
    before = {n: df.count() for n, df in house.star().items()}
    versions = {e: house.silver_table(e).latest_version() for e in ENTITIES}
    house.run(f"{house.root.removesuffix('/tables')}/landing", NOW)
    assert {n: df.count() for n, df in house.star().items()} == before
    assert {e: house.silver_table(e).latest_version() for e in ENTITIES} == versions


def test_runs_equal_one_batch_after_parents_change(spark, tmp_path):
    """An order gets a new day and customer, and a translation comes after its product."""
    root = str(tmp_path)
    house = Warehouse(spark, f"{root}/tables")
    rest = {k: v for k, v in REST.items() if k != "product_category_name_translation"}
    rest["products"] = [{**rest["products"][0], "product_category_name": "automotivo"}]
    land(spark, f"{root}/landing", orders=[order("x"), order("y")], order_items=[item("x"), item("y")], **rest)
    house.run(f"{root}/landing", NOW, [e for e in ENTITIES if e != "product_category_name_translation"], upkeep=None)
    land(
        spark,
        f"{root}/landing",
        orders=[order("x", "U", "2018-08-07 00:00:00", bought="2018-08-03 10:00:00", customer_id="other")],
        product_category_name_translation=REST["product_category_name_translation"],
    )
    for _ in range(2):
        house.run(f"{root}/landing", NOW)
        batch = build_star(lambda e: house.silver_table(e).read(), NOW)
        for name, df in house.star().items():
            columns = [c for c in df.columns if not c.startswith("_")]
            assert as_set(df, *columns) == as_set(batch[name], *columns), name
    assert as_set(house.star()["dim_product"], "product_category_name_english") == {("auto",)}


def test_some_entities_make_some_tables(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/tables")
    land(spark, f"{tmp_path}/landing", orders=[order("x")])
    house.run(f"{tmp_path}/landing", NOW, entities=("orders",))
    assert set(house.star()) == {"dim_date", "dim_order"}


def test_a_renewed_checkpoint_loses_no_row(spark, tmp_path):
    """Two checkpoints count their batches from 0; both write into one table."""
    root, table = str(tmp_path), Warehouse(spark, f"{tmp_path}/t").silver_table("orders")
    for k, name in enumerate(("a", "b")):
        land(spark, f"{root}/landing-{name}", orders=[order(name), {**order(f"bad-{name}"), "order_status": "bogus"}])
        rows = read_landing(spark, f"{root}/landing-{name}", "orders").withColumn("_ingested_at", F.lit("2018-08-09").cast("timestamp_ntz"))
        rows.write.parquet(f"{root}/rows-{name}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/rows-{name}")
        runs.silver_stream(stream, "orders", table, f"{root}/bad", f"{root}/checkpoint-{k}", NOW).awaitTermination()
    assert as_set(table.read(), "order_id") == {("a",), ("b",)}
    assert as_set(spark.read.parquet(f"{root}/bad"), "order_id") == {("bad-a",), ("bad-b",)}


def test_landing_folders_prune(spark, house):
    landing = read_landing(spark, f"{house.root.removesuffix('/tables')}/landing", "orders")
    one_day = landing.filter("year = 2018 and month = 8 and day = 8")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert as_set(one_day, "order_id") == {("y",)}


def test_a_new_column_reaches_silver(spark, tmp_path):
    root = str(tmp_path)
    house = Warehouse(spark, f"{root}/tables")
    land(spark, f"{root}/landing", orders=[order("a")])
    later = rows(spark, "orders", order("b", at="2018-08-06 00:00:00")).drop("_ingested_at")
    for evolve in (False, True):
        if evolve:
            write_landing(later.withColumn("channel", F.lit("app")), f"{root}/landing", "orders", FIRST)
        added = {"orders": added_columns(spark, f"{root}/landing", "orders")}
        house.run_bronze(f"{root}/landing", NOW, added)
        house.run_silver(NOW, added)
    got = house.silver_table("orders").read()
    assert as_set(got, "order_id", "channel") == {("a", None), ("b", "app")}
    assert got.filter("_source_file_path like '%/day=6/%'").count() == 1


def test_published_tables_are_clustered(spark, house, tmp_path):
    house.publish(str(tmp_path / "gold"))
    for name, df in house.star().items():
        assert spark.read.parquet(str(tmp_path / "gold" / name)).count() == df.count()


BOUGHT = ("orders", "order_items")


def written(house, name):
    """How often each order's rows were written to a gold table."""
    folders = house.gold_table(name)._changes().values()
    return Counter(r[0] for f in folders for r in house.spark.read.parquet(f).select("order_id").collect())


def test_a_new_row_with_a_new_parent_is_staged_once(spark, tmp_path):
    landing, house = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "house"))
    land(spark, landing, orders=[order("o1")], order_items=[item("o1"), item("o9")])
    house.run(landing, NOW, BOUGHT, upkeep=None)
    moved = order("o1", "U", "2018-08-06 10:00:00", bought="2018-08-02 09:00:00")
    land(spark, landing, orders=[moved, order("o2"), order("o9")], order_items=[item("o2"), item("o1", op="U", at="2018-08-01 10:00:00", price=99.0)])
    house.run(landing, NOW, BOUGHT, upkeep=None)
    assert written(house, "fact_order_items") == {"o1": 3, "o9": 2, "o2": 1}  # o1: at first, for its order, for its own late change
    facts, orders = house.star()["fact_order_items"], house.star()["dim_order"]
    assert as_set(facts, "order_id", "price") == {("o1", 10.0), ("o2", 10.0), ("o9", 10.0)}
    assert facts.join(orders, ["order_id", "order_sk", "purchase_date_sk"]).count() == 3


def test_what_gold_was_given_may_be_unknown(spark, tmp_path):
    """Without a note of what gold has seen, or after a rollback, all rows whose parent changed are staged."""
    landing, house = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "house"))
    land(spark, landing, order_items=[item("o1")])
    house.run(landing, NOW, ("order_items",), upkeep=None)
    house.silver_table("order_items").rollback(1)
    assert house._seen("fact_order_items").count() == 1
    remove(spark, house._checkpoint("seen-fact_order_items"))
    land(spark, landing, orders=[order("o1")])
    house.run(landing, NOW, BOUGHT, upkeep=None)
    assert house.star()["fact_order_items"].filter("order_sk is not null").count() == 1


def test_several_merges_in_one_micro_batch_are_reduced(spark, tmp_path):
    landing, house = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "house"))
    for at, price in (("2018-08-05 10:00:00", 1.0), ("2018-08-06 10:00:00", 2.0)):
        land(spark, landing, order_items=[item("o1", price=price, at=at)])
        house.run_bronze(landing, NOW, {"order_items": ()})
        house.run_silver(NOW, {"order_items": ()})
    house.run_gold(NOW)
    assert written(house, "fact_order_items") == {"o1": 1}
    assert as_set(house.star()["fact_order_items"], "price") == {(2.0,)}
