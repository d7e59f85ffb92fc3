from datetime import datetime

from pyspark.sql import functions as F

from tests.helpers import as_set, item, order, rows, ts
from tidemark.entities import ENTITIES
from tidemark.operators import quality
from tidemark.plans import silver

NOW = datetime(2024, 5, 6, 7, 8, 9)


def reasons(spark, entity, *dicts, **options):
    return [r._quarantine_reason for r in silver.quarantine(rows(spark, entity, *dicts), entity, NOW, **options).collect()]


def test_first_failing_rule_names_the_reason(spark):
    bad = {"order_id": None, "customer_id": "c", "order_status": "created", "OP": "I", "AR_H_COMMIT_TIMESTAMP": ts("2018-08-07 08:00:18")}
    assert reasons(spark, "orders", bad) == ["null_purchase_timestamp"]
    negative = item("x", 0, -99.99, None, at="2018-08-09 09:00:38")
    assert reasons(spark, "order_items", negative) == ["negative_price"]


def test_every_rule_of_items(spark):
    cases = {
        "negative_freight_value": item("a", freight=-1.0),
        "null_order_id": item(None),
        "null_product_id": item("a", product_id=None),
        "null_seller_id": item("a", seller_id=None),
        "null_pk": item("a", None),
    }
    for reason, row in cases.items():
        assert reasons(spark, "order_items", row) == [reason]


def test_rules_of_the_other_entities(spark):
    assert reasons(spark, "products", {"product_id": "p", "product_width_cm": 0.0, "OP": "I"}) == ["non_positive_width"]
    assert reasons(spark, "products", {"product_id": None, "OP": "I"}) == ["null_pk"]
    pay = {"order_id": "o", "payment_sequential": 1, "payment_type": "boleto", "payment_installments": 1, "OP": "I"}
    assert reasons(spark, "payments", pay | {"payment_value": -1.0}) == ["negative_payment_value"]
    assert reasons(spark, "payments", pay | {"payment_value": 1.0, "payment_type": "cash"}) == ["invalid_payment_type"]
    assert reasons(spark, "payments", pay | {"payment_value": 1.0, "payment_installments": 0}) == ["invalid_installments"]
    assert reasons(spark, "reviews", {"review_id": None, "order_id": "o", "review_score": 3, "OP": "I"}) == ["null_pk"]
    assert reasons(spark, "product_category_name_translation", {"OP": "I"}) == ["null_pk"]
    assert reasons(spark, "orders", order("o", customer_id=None)) == ["null_customer_id"]


def test_null_conditions_are_kept_or_dropped(spark):
    customer = {"customer_id": "c", "customer_state": None, "OP": "I"}
    assert reasons(spark, "customers", customer) == ["invalid_state"]
    assert reasons(spark, "customers", customer, on_null="drop") == []
    df = rows(spark, "customers", customer)
    assert silver.clean(df, "customers", NOW).count() == 0
    assert silver.clean(df, "customers", NOW, on_null="drop").count() == 0


def test_null_operation_is_an_upsert_unless_dropped(spark):
    df = rows(spark, "orders", order("o", op=None))
    assert silver.clean(df, "orders", NOW).count() == 1
    assert silver.clean(df, "orders", NOW, null_op="drop").count() == 0


def test_deletes_pass_unchecked_and_unstamped(spark):
    df = rows(spark, "orders", {"order_id": "o", "OP": "D"}, order("p"))
    got = as_set(silver.clean(df, "orders", NOW), "order_id", "_silver_processed_at")
    assert got == {("o", None), ("p", datetime(2018, 8, 9, 7, 8, 9))}
    assert silver.quarantine(df, "orders", NOW).count() == 0


def test_without_operation_column_every_row_is_checked(spark):
    df = rows(spark, "orders", order("o", status="bogus"), order("p")).drop("OP")
    assert [r.order_id for r in silver.clean(df, "orders", NOW).collect()] == ["p"]


def test_malformed_values_get_their_own_reason(spark):
    df = rows(spark, "order_items", item("o")).withColumn("price", F.lit("ten"))
    bad = silver.quarantine(df, "order_items", NOW, flag_malformed=True).collect()
    assert [r._quarantine_reason for r in bad] == ["malformed_price"]


def test_nothing_is_lost(spark, sf):
    from tidemark.sources import testbed

    for entity in ENTITIES:
        df = testbed.received(spark, sf, entity)
        good, bad = silver.clean(df, entity, NOW), silver.quarantine(df, entity, NOW)
        assert good.count() + bad.count() == df.count()


def test_no_rules_reject_nothing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert quality.rejected(quality.apply_rules(df, [])).count() == 0


def test_rejected_rows_carry_their_origin(spark):
    r = silver.quarantine(rows(spark, "order_items", item("x", price=-1.0)), "order_items", NOW).first()
    assert r._quarantine_table_name == "order_items"
    assert str(r._quarantine_date) == "2018-08-09" and r._quarantine_failed_at == datetime(2018, 8, 9, 7, 8, 9)
