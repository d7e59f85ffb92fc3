"""Queries prepare the inputs they read, and ledgers write few files."""

import glob
import os
import time

from pyspark.sql import types as T

from tidemark.plans.medallion import Tables, store_star
from tidemark.registry.sketched import exact_counts
from tidemark.sources import testbed
from tidemark.streaming.ledger import Ledger


def test_a_ledger_writes_a_file_or_two_a_bucket(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), T.StructType([T.StructField("k", T.LongType())]), ["k"])
    rows = spark.range(20_000).repartition(8).withColumnRenamed("id", "k")
    for batch, stored in (("a", True), ("b", False)):
        ledger.add(rows, batch, stored)
        assert len(glob.glob(f"{tmp_path}/g=0/_batch={batch}/*/*.parquet")) <= 64 + 8
    assert ledger.rows().count() == 40_000 and ledger.holds("a")


def test_only_named_tables_are_stored(spark, tmp_path):
    tables = Tables({n: lambda: spark.range(3) for n in ("dim_date", "dim_customer")})
    assert list(store_star(spark, tables, None, str(tmp_path), ("dim_date",))) == ["dim_date"]
    assert os.listdir(tmp_path) == ["dim_date"]


def test_counts_of_all_levels(spark):
    kind = "year int, year_month string, is_weekend boolean, order_id string, seller_id string, product_id string"
    rows = [(2001, "2001-01", True, "a", "s", None), (2001, "2001-02", False, "a", "t", None), (2002, "2002-01", True, "b", "s", "p")] * 2
    found = {(r.level, r.member): (r.orders, r.sellers, r.products) for r in exact_counts(spark.createDataFrame(rows, kind)).collect()}
    assert found["all", "all"] == (2, 2, 1) and found["year", "2001"] == (1, 2, 0) and found["weekend", "true"] == (2, 1, 1)


def test_shuffle_files_go_with_the_job_that_wrote_them(spark, sf, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in found.mkString("\n").split("\n") if "/shuffle_" in f}

    before, there = spark.conf.get(name, None), files()
    spark.conf.unset(name)
    try:
        rows = testbed.changes(spark, sf, "orders").groupBy("customer_id").count()
        rows.write.parquet(str(tmp_path / "rows"))
        until = time.time() + 20
        while files() - there and time.time() < until:  # executors are told, not waited for
            time.sleep(0.2)
        assert not files() - there
        assert rows.count() == rows.count() == spark.read.parquet(str(tmp_path / "rows")).count()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
