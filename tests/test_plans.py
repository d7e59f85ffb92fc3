"""Plans must read little, shuffle reduced rows and stay on the cluster."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cdc import scd1_apply
from tidemark.plans import star
from tidemark.registry import REGISTRY
from tidemark.registry.base import current


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_a_measure_needs(spark, sf):
    text = plan(REGISTRY["total_payment_value"].build(spark, sf))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and not any("o_custkey" in s for s in schemas)


@pytest.mark.parametrize("name", ["total_gmv", "total_orders", "aov", "csat", "total_payment_value", "seller_count", "payment_mix"])
def test_measures_join_only_what_they_use(spark, sf, name):
    text = plan(REGISTRY[name].build(spark, sf))
    assert "Join" not in text and text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["delivery_vs_review", "drill_across"])
def test_reports_over_several_facts_read_each_stored_fact_once(spark, sf, name):
    files = [re.sub(r".*/", "", f.rsplit("/", 1)[0]) for f in REGISTRY[name].build(spark, sf).inputFiles()]
    scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan(REGISTRY[name].build(spark, sf)))
    assert set(files) <= {"fact_order_items", "fact_payments", "fact_reviews", "dim_order", "dim_date"}
    assert 2 <= len(scans) <= 6 and not any("o_orderkey" in s for s in scans)


def test_versions_are_reduced_before_the_shuffle(spark, sf):
    text = plan(REGISTRY["scd1_apply"].build(spark, sf))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("hashpartitioning") < text.index("Partial")


def test_unread_columns_stay_before_the_shuffle(spark, sf):
    text = plan(current(spark, sf, "order_items").select("order_id", "price"))
    assert "xxhash64" in text and "seller_id" not in text[: text.index("hashpartitioning")]


@pytest.mark.parametrize("name", ["clean_order_items", "quarantine_order_items", "apply_rules", "bronze_metadata"])
def test_row_rules_do_not_shuffle(spark, sf, name):
    text = plan(REGISTRY[name].build(spark, sf))
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_no_python_runs_inside_queries(spark, sf):
    for name in ("monthly_gmv_orders", "true_carts", "change_feed", "star_join"):
        text = plan(REGISTRY[name].build(spark, sf))
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sales_add_up_before_they_meet_a_small_dimension(spark, sf):
    text = plan(REGISTRY["top_categories"].build(spark, sf))
    assert text.index("_sum_gmv_item") > 0 and "product_sk" in text


def test_top_categories_keep_only_the_top(spark, sf):
    assert "TakeOrderedAndProject" in plan(REGISTRY["top_categories"].build(spark, sf))


def test_a_hot_order_is_split_in_its_join(spark):
    """A third of the items belong to one order; both sides come fresh from a keyed reduction."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(0, 200_000, 1, 8).selectExpr(
            "concat('o', if(id % 3 = 0, 0, id)) as order_id", "id as n", "id as seq", "'I' as OP"
        )
        orders = spark.range(0, 200_000, 1, 8).selectExpr("concat('o', id) as order_id", "id as order_sk", "1 as seq")
        gone = F.lit(False)
        left = scd1_apply(items, ["order_id", "n"], F.col("seq"), gone)
        right = scd1_apply(orders, ["order_id"], F.col("seq"), gone)
        joined = star.join_order_keys(left, right, "order_sk")
        rows = joined.collect()
        assert len(rows) == 200_000 and all(r.order_sk is not None for r in rows)
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
