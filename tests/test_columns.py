from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_set
from tidemark.functions import columns, commerce
from tidemark.functions.calendar import date_spine, purchase_bounds
from tidemark.functions.keys import surrogate_key
from tidemark.sources import files


def test_trim_keeps_blank_strings_and_other_types(spark):
    df = spark.createDataFrame([(" a ", 1), ("  ", 2), (None, 3)], "s string, n int")
    assert as_set(columns.trim_all_strings(df), "s", "n") == {("a", 1), ("", 2), (None, 3)}


def test_cast_flags_the_first_value_that_does_not_parse(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "y"), (None, "z")], "a string, b string")
    got = columns.cast_columns(df, {"a": "int", "b": "double", "absent": "int"}, flag="bad")
    assert as_set(got, "a", "b", "bad") == {(1, 2.5, None), (None, None, "a"), (None, None, "b")}


def test_string_target_lower_cases(spark):
    df = spark.createDataFrame([("ABC",)], "a string")
    assert columns.cast_columns(df, {"a": "string"}).first().a == "abc"


def test_on_day_moves_the_clock(spark):
    df = spark.sql("select timestamp_ntz'2018-08-05 23:00:00' as t")
    got = df.select(columns.on_day(F.col("t"), datetime(2024, 1, 1, 6, 7, 8)).alias("x")).first().x
    assert got == datetime(2018, 8, 5, 6, 7, 8)


def test_surrogate_keys_are_null_safe_and_unambiguous(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), (None, "b")], "x string, y string")
    for mode in ("xxhash64", "md5_60", "murmur3"):
        keys = [r.k for r in df.select(surrogate_key("x", "y", mode=mode).alias("k")).collect()]
        assert keys[2] is None and all(k >= 0 for k in keys[:2])
        assert keys[0] != keys[1]


def test_murmur_mode_matches_the_plain_hash(spark):
    df = spark.range(2000).selectExpr("concat('k', id) as x")
    got = df.select(surrogate_key("x", mode="murmur3").alias("a"), F.abs(F.hash("x").cast("bigint")).alias("b"))
    assert got.filter("a <> b").count() == 0


def test_wide_keys_do_not_collide(spark):
    df = spark.range(300_000).selectExpr("concat('O', id) as x")
    assert df.select(surrogate_key("x").alias("k")).distinct().count() == 300_000


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        surrogate_key(F.lit("a"), mode="crc")


def test_calendar_of_no_orders_is_empty(spark):
    none = spark.createDataFrame([], "order_purchase_timestamp timestamp_ntz")
    assert date_spine(purchase_bounds(none)).count() == 0


def test_same_day_delivery_is_late_against_a_midnight_promise(spark):
    df = spark.sql(
        "select timestamp_ntz'2018-01-01 10:00:00' as order_purchase_timestamp,"
        " timestamp_ntz'2018-01-05 08:00:00' as order_delivered_customer_date,"
        " timestamp_ntz'2018-01-05 00:00:00' as order_estimated_delivery_date, 'delivered' as order_status"
    )
    got = df.select(*[c.alias(n) for n, c in commerce.delivery_metrics().items()], commerce.is_late().alias("late"))
    r = got.first()
    assert (r.delivery_days, r.estimated_days, r.delivery_delta_days) == (4, 4, 0)
    assert r.is_on_time is False and r.late is True and r.is_delivered is True


def test_unknown_state_stands_for_itself(spark):
    df = spark.createDataFrame([("SP",), ("XX",), (None,)], "customer_state string")
    got = as_set(commerce.geo_enrich(df), "customer_state", "country", "state_full")
    assert got == {("SP", "Brazil", "São Paulo"), ("XX", "Brazil", "XX"), (None, "Brazil", None)}


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_bytes("﻿product_category_name,product_category_name_english\nautomotivo,auto\n".encode())
    got = files.read_entity_csv(spark, str(path), "product_category_name_translation")
    assert [tuple(r) for r in got.collect()] == [("automotivo", "auto")]


def test_csv_dates_and_quotes(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        'review_answer_timestamp\nr1,o1,5,,"good, ""very"" good\nindeed",2018-01-18,2018-01-18 21:46:59\n'
    )
    r = files.read_entity_csv(spark, str(path), "reviews").first()
    assert r.review_comment_message == 'good, "very" good\nindeed' and r.review_comment_title is None
    assert r.review_answer_timestamp == datetime(2018, 1, 18, 21, 46, 59)


def test_clustered_files_cover_separate_ranges(spark, tmp_path):
    path = str(tmp_path / "clustered")
    files.write_clustered(spark.range(0, 10_000).selectExpr("hash(id) as k", "id"), path, ["k"], files=4)
    ranges = sorted((r.low, r.high) for r in files.file_ranges(spark, path, "k").collect())
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_partitioned_layout_prunes(spark, tmp_path):
    path = str(tmp_path / "by-state")
    df = spark.createDataFrame([("a", "SP"), ("b", "RJ"), ("c", "SP")], "customer_id string, customer_state string")
    files.write_partitioned(df, path, ["customer_state"])
    back = spark.read.parquet(path).filter("customer_state = 'SP'")
    assert as_set(back, "customer_id") == {("a",), ("c",)}
    assert "PartitionFilters: [isnotnull(customer_state" in back._jdf.queryExecution().executedPlan().toString()
