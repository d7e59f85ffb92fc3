"""What runs keep beside the star: live measures, rows that wait for a parent, placeholders of late members."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import as_set, item, order, rows, ts
from tidemark.entities import ENTITIES
from tidemark.plans import silver
from tidemark.plans.analyses import kpi_cards, monthly_gmv_orders
from tidemark.plans.live import LIVE, Live, LiveMeasures, live_cards, live_monthly
from tidemark.plans.medallion import Warehouse, build_star
from tidemark.operators.quality import REASON
from tidemark.sources.landing import write_landing
from tidemark.streaming.ledger import Ledger

NOW = datetime(2024, 5, 6, 7, 8, 9)
FIRST = date(2018, 8, 5)


def land(spark, root, **tables):
    for entity, data in tables.items():
        write_landing(rows(spark, entity, *data).drop("_ingested_at"), root, entity, FIRST)


def plain(df):
    return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()], key=repr)


# -- live measures on their own -----------------------------------------------------------------------------------

SPEC = Live(
    "t",
    {"g": T.StringType()},
    {"v": "v"},
    {"owners": "owner"},
    {"first": "v"},
    {"last": "v"},
    bound_type=T.DoubleType(),
)
ORDER = T.StructType([T.StructField("sequence", T.LongType()), T.StructField("deleted", T.BooleanType()), T.StructField("digest", T.LongType())])


def live(spark, path, spec=SPEC):
    return LiveMeasures(spark, str(path), spec, {"k": T.LongType()}, ORDER)


def changes(spark, data):
    """Change rows from (k, sequence, deleted, g, v, owner)."""
    schema = "k long, seq long, _deleted boolean, g string, v double, owner string"
    order = F.struct(F.col("seq").alias("sequence"), F.col("_deleted").alias("deleted"), F.xxhash64("g", "v", "owner").alias("digest"))
    return spark.createDataFrame(data, schema).withColumn("_order", order)


def expected(data):
    """Figures by group, from the last change of every key."""
    last = {}
    for r in data:
        if r[0] not in last or (r[1], r[2]) >= (last[r[0]][1], last[r[0]][2]):
            last[r[0]] = r
    groups = {}
    for _, _, deleted, g, v, owner in last.values():
        if not deleted:
            groups.setdefault(g, []).append((v, owner))
    out = []
    for g, found in groups.items():
        vs = [v for v, _ in found if v is not None]
        total = round(sum(vs), 6) if vs else None
        out.append((g, len(found), len(vs), len({o for _, o in found if o is not None}), total, min(vs, default=None), max(vs, default=None)))
    return sorted(out, key=repr)


def figures(measures):
    found = measures.read().select("g", "rows", "n_v", "owners", F.round(F.col("sum_v").cast("double"), 6), "first", "last")
    return sorted(map(tuple, found.collect()), key=repr)


def random_changes(rng, n, start):
    out, used = [], set()
    for i in range(n):
        k = rng.randrange(12)
        key = (k, start + i)
        if key in used:
            continue
        used.add(key)
        g, owner = rng.choice(["a", "b", None]), rng.choice(["x", "y", "z", None])
        out.append((k, start + i, rng.random() < 0.25, g, rng.choice([None, 0.1, 0.2, 1.5, -3.0, 99.99]), owner))
    return out


def test_figures_follow_any_changes(spark, tmp_path):
    rng, data, measures = random.Random(11), [], live(spark, tmp_path)
    for step in range(6):
        part = random_changes(rng, 14, 100 * step)
        late = [(k, s - 150, *rest) for k, s, *rest in random_changes(rng, 3, 100 * step)] if step > 2 else []
        data += part + late
        measures.apply(changes(spark, part + late), f"b-{step}")
        if step == 3:
            assert measures.fold(most=1)
        if step in (2, 5):
            assert figures(measures) == expected(data)


def test_a_repeated_micro_batch_counts_once(spark, tmp_path):
    measures = live(spark, tmp_path)
    first = [(1, 1, False, "a", 5.0, "x"), (2, 1, False, "a", 7.0, "x"), (3, 1, False, "b", 1.0, "y")]
    second = [(1, 2, True, "a", 5.0, "x"), (2, 2, False, "b", 8.0, "z"), (4, 1, False, None, None, None)]
    for batch, part in (("s-0", first), ("s-0", first), ("s-1", second), ("s-1", second)):
        measures.apply(changes(spark, part), batch)
    assert figures(measures) == expected(first + second)
    measures.apply(changes(spark, []), "s-2")
    assert figures(measures) == expected(first + second)


def test_a_lost_bound_is_read_again_and_others_are_not(spark, tmp_path, monkeypatch):
    measures, reads, real = live(spark, tmp_path), [], Ledger.rows
    measures.apply(changes(spark, [(k, 1, False, "a", float(k), "x") for k in range(1, 6)]), "s-0")
    monkeypatch.setattr(Ledger, "rows", lambda self, without=None: reads.append((self.path.rsplit("/", 1)[1], without)) or real(self, without))
    measures.apply(changes(spark, [(3, 2, True, "a", 3.0, "x"), (9, 1, False, "a", 4.5, "x")]), "s-1")
    assert ("rows", None) not in reads
    measures.apply(changes(spark, [(5, 2, False, "a", 2.0, "x")]), "s-2")
    assert ("rows", None) in reads
    assert measures.read().select("first", "last").first() == (1.0, 4.5)


def test_a_small_change_reads_few_files(spark, tmp_path):
    measures = live(spark, tmp_path)
    measures.apply(changes(spark, [(k, 1, False, "a", 1.0, str(k)) for k in range(2000)]), "s-0")
    found = measures.rows.lookup(changes(spark, [(7, 2, False, "a", 2.0, "7")]), "s-1")
    assert len(found.inputFiles()) >= 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket", plan) and found.count() == 1


def test_many_changes_are_dealt_once_and_stored_with_what_they_replace(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.streaming.ledger.FEW", 0)  # every micro-batch counts as one of many keys
    rng, data, measures = random.Random(5), [], live(spark, tmp_path)
    for step in range(3):
        part = random_changes(rng, 14, 100 * step)
        data += part
        if step == 2:
            changed = measures._changed(measures._contributions(changes(spark, part)), "b-2")
            plan = changed._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(r"Exchange \w+partitioning", plan)) == 1
        measures.apply(changes(spark, part), f"b-{step}")
    assert figures(measures) == expected(data)
    last, known = {}, {r[0]: r for r in sorted(data[: -len(part)])}
    for r in sorted(part):
        last[r[0]] = r
    replaced = {k: None if k not in known or known[k][2] else known[k][4] for k in last}
    stored = {r.k: r._before and r._before.sum_v for r in measures.rows.part("b-2").collect()}
    assert {k: v if v is None else float(v) for k, v in stored.items()} == replaced


# -- runs ---------------------------------------------------------------------------------------------------------


def deliveries():
    people = [{"customer_id": f"c-{o}", "customer_unique_id": f"u{i // 2}", "customer_state": "SP", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")} for i, o in enumerate("xyzw")]
    shops = [{"seller_id": s, "seller_state": "SP", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")} for s in ("s1", "s2")]
    goods = [{"product_id": "p1", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}]
    names = [{"product_category_name": "a", "product_category_name_english": "b", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}]

    def review(i, o, score, op="I", at="2018-08-04"):
        return {"review_id": i, "order_id": o, "review_score": score, "OP": op, "AR_H_COMMIT_TIMESTAMP": ts(at)}

    def paid(o, n, value):
        return {"order_id": o, "payment_sequential": n, "payment_type": "boleto", "payment_installments": 1, "payment_value": value, "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-01")}

    return [
        {
            "orders": [order("x"), order("y", bought="2018-09-02 10:00:00"), order("z", status="delivered", order_delivered_customer_date=ts("2018-08-04"))],
            "order_items": [item("x"), item("x", 2, 99.99, 0.01), item("y"), item("w", 1, 7.0), item("z", 1, seller_id="s2")],
            "customers": people[:2],
            "sellers": shops[:1],
            "products": goods,
            "product_category_name_translation": names,
            "payments": [paid("x", 1, 10.0)],
            "reviews": [review("r1", "x", 5), review("r2", "w", 1)],
        },
        {
            "orders": [order("w", "U", "2018-08-07 00:00:00"), order("x", "U", "2018-08-07 01:00:00", bought="2018-10-01 00:00:00"), order("y", "D", "2018-08-09 00:00:00")],
            "order_items": [item("x", 2, op="D", at="2018-08-09 10:00:00"), item("z", 1, 1.0, 1.0, "U", "2018-08-09 11:00:00", seller_id="s2"), item("never", 1, 3.0)],
            "customers": people[2:],
            "reviews": [review("r1", "x", 2, "U", "2018-08-06")],
        },
        {
            "sellers": shops[1:],
            "order_items": [item("w", 1, 8.0, 0.5, "U", "2018-08-10 00:00:00"), item("v", 1, product_id="p9", seller_id="s9")],
            "orders": [order("x", "D", "2018-08-11 00:00:00"), order("v", at="2018-08-12 00:00:00", bought="2019-01-01 00:00:00", customer_id="nobody")],
        },
    ]


def test_live_measures_equal_the_batch_after_every_run(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/tables", live=[n for n in LIVE if n != "purchases"])
    for k, delivery in enumerate(deliveries()):
        land(spark, f"{tmp_path}/landing", **delivery)
        house.run(f"{tmp_path}/landing", NOW)
        star = house.star()
        assert plain(live_monthly(house.figures)) == plain(monthly_gmv_orders(star)) != []
        assert plain(live_cards(house.figures)) == plain(kpi_cards(star))
        bounds = house.silver_table("orders").read().agg(F.min("order_purchase_timestamp"), F.max("order_purchase_timestamp")).first()
        assert tuple(house.figures("purchases").select("first_purchase", "last_purchase").first()) == tuple(bounds)
    before = plain(live_cards(house.figures))
    house.run(f"{tmp_path}/landing", NOW)
    assert plain(live_cards(house.figures)) == before


@pytest.fixture(scope="module")
def checked(spark, tmp_path_factory):
    """After each delivery: silver items, waiting items, orphan keys and late members."""
    root = str(tmp_path_factory.mktemp("checked"))
    house, seen = Warehouse(spark, f"{root}/tables", checked=["order_items", "reviews"], inferred=True), []
    for k, delivery in enumerate(deliveries()):
        land(spark, f"{root}/landing", **delivery)
        for _ in range(1 + (k == 2)):  # the run after the last delivery finds nothing new
            house.run(f"{root}/landing", NOW)
        waiting = house.quarantine("order_items").select("order_id", "order_item_id", REASON)
        star = house.star()
        seen.append(
            {
                "silver": as_set(house.silver_table("order_items").read(), "order_id", "order_item_id", "price"),
                "waiting": sorted(map(tuple, waiting.collect())),
                "late": as_set(house.late_members("dim_seller"), "seller_id", "arrived_at"),
                "sellers": as_set(star["dim_seller"], "seller_id", "_is_inferred"),
                "customers": as_set(star["dim_customer"], "customer_id", "_is_inferred"),
                "orphans": [
                    star["fact_order_items"].join(star[d], k, "left_anti").filter(F.col(k).isNotNull()).count()
                    for d, k in (("dim_seller", "seller_sk"), ("dim_product", "product_sk"), ("dim_customer", "customer_sk"))
                ],
            }
        )
    return house, seen


def test_items_wait_for_their_order_and_come_out_once(checked):
    _, seen = checked
    assert seen[0]["waiting"] == [("w", 1, "unknown_order")]
    assert seen[1]["waiting"] == [("never", 1, "unknown_order")]
    assert seen[2]["waiting"] == [("never", 1, "unknown_order")]
    assert ("w", 1, 7.0) in seen[1]["silver"] and ("w", 1, 8.0) in seen[2]["silver"]
    assert {k[:2] for k in seen[0]["silver"]} == {("x", 1), ("x", 2), ("y", 1), ("z", 1)}
    for s in seen:
        assert not {k[:2] for k in s["silver"]} & {k[:2] for k in s["waiting"]}


def test_runs_with_references_equal_the_batch(spark, checked):
    """Where no parent was deleted, the batch over all rows and all parents has the same current rows."""
    house, seen = checked
    parents = {"orders": house.silver_table("orders").read_all()}
    data = [r for d in deliveries() for r in d.get("order_items", [])]
    tagged = silver.tagged(rows(spark, "order_items", *data), "order_items", parents=parents)
    bad = tagged.filter(F.col(REASON) == "unknown_order")
    assert as_set(bad, "order_id", "order_item_id") == {("never", 1)}


def test_runs_count_what_they_judge(checked):
    house, _ = checked
    counts = {(r.table_name, r.reason): r.rows for r in house.run_metrics().collect()}
    assert counts["order_items", "read"] == 10 and counts["order_items", "unknown_order"] == 2 and counts["order_items", None] == 8
    assert counts["orders", "read"] == counts["orders", None] == 8
    for table in ("orders", "order_items", "reviews", "sellers"):
        assert counts[table, "read"] == sum(n for (t, r), n in counts.items() if t == table and r != "read")


def test_a_repeated_micro_batch_is_counted_once(spark, tmp_path):
    from tidemark.streaming import runs

    for n in (5, 3):
        runs.store_metrics(spark, {"read": n, "clean": n - 1, "r0": 1, "r1": 0}, "orders", ["a", "b"], f"{tmp_path}/tables/metrics/orders/batch=x-0")
    found = Warehouse(spark, f"{tmp_path}/tables").run_metrics()
    assert as_set(found, "reason", "rows") == {("read", 3), (None, 2), ("a", 1)}


def test_a_waiting_row_can_be_deleted(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/tables", checked=["order_items"])
    first = {"orders": [order("a")], "order_items": [item("b"), item("a")]}
    land(spark, f"{tmp_path}/landing", **first)
    house.run(f"{tmp_path}/landing", NOW, ("orders", "order_items"))
    land(spark, f"{tmp_path}/landing", order_items=[item("b", op="D", at="2018-08-06 00:00:00")], orders=[order("b", at="2018-08-07 00:00:00")])
    house.run(f"{tmp_path}/landing", NOW, ("orders", "order_items"))
    assert as_set(house.silver_table("order_items").read(), "order_id") == {("a",)}
    assert house.quarantine("order_items").count() == 0


def test_a_release_that_is_repeated_changes_nothing(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/tables", checked=["order_items"])
    land(spark, f"{tmp_path}/landing", orders=[order("a")], order_items=[item("b"), item("b", 2)])
    house.run(f"{tmp_path}/landing", NOW, ("orders", "order_items"), upkeep=None)
    land(spark, f"{tmp_path}/landing", orders=[order("b")])
    house.run_bronze(f"{tmp_path}/landing", NOW, {"orders": ()})
    house.run_silver(NOW, {"orders": ()})
    table, waiting = house.silver_table("order_items"), house.waiting_table("order_items")
    expected = as_set(table.read(), "order_id", "order_item_id")
    assert expected == {("b", 1), ("b", 2)} and waiting.read().count() == 0
    from tidemark.streaming import runs

    again = []
    original = runs.for_each_batch
    try:
        runs.for_each_batch = lambda stream, checkpoint, step: again.append(step)
        name = next(r.batch for r in waiting.read_all().select(F.col(runs.RELEASED_BY).alias("batch")).collect() if r.batch)
        parent = house.silver_table("orders")
        runs.release_stream(parent.read(), "order_id", "order_items", waiting, table, lambda held: {"orders": parent.read()}, "", NOW)
        again[0](parent.read(), name)
    finally:
        runs.for_each_batch = original
    assert as_set(table.read(), "order_id", "order_item_id") == expected
    assert waiting.read().count() == 0


def test_no_orphan_key_is_left_and_members_arrive_once(checked):
    _, seen = checked
    assert all(s["orphans"] == [0, 0, 0] for s in seen)
    assert seen[0]["sellers"] == {("s1", None), ("s2", True)}
    assert seen[2]["sellers"] == {("s1", None), ("s2", None), ("s9", True)}
    assert ("c-z", True) in seen[0]["customers"] and ("c-z", None) in seen[1]["customers"]
    assert ("nobody", True) in seen[2]["customers"]
    assert {s for s, at in seen[0]["late"] if at is None} == {"s2"}
    assert {(s, at is None) for s, at in seen[2]["late"]} == {("s2", False), ("s9", True)}


def test_placeholders_do_not_change_once_named(spark, checked):
    house, _ = checked
    rows_ = house.gold_table("dim_seller").read_all().groupBy("seller_id").count()
    assert rows_.filter("count > 1").count() == 0
    assert set(house.star()) == {"dim_date", "dim_customer", "dim_seller", "dim_product", "dim_order", "fact_order_items", "fact_payments", "fact_reviews"}
    batch = build_star(lambda e: house.silver_table(e).read(), NOW)
    for name in ("dim_seller", "dim_customer", "dim_product"):
        real = house.star()[name].filter("_is_inferred is null")
        columns = [c for c in batch[name].columns if not c.startswith("_")]
        assert as_set(real, *columns) == as_set(batch[name], *columns)


def test_every_reference_names_an_entity():
    assert all(r.parent in ENTITIES for e in ENTITIES.values() for r in e.references)
