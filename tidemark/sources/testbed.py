"""The test tables seen as the eight source entities, one row per change.

Every frame here is a projection of at most three tables; nothing is cached or collected.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.entities import COMMIT_TS, ENTITIES, OP, STATES
from tidemark.functions.columns import on_day
from tidemark.session import short_shuffles, small_reads

# Fixed values of the test bed: when the initial load was taken, and the clock of every run.
LOAD_TS = "1994-12-31 23:59:59"
NOW = datetime(2001, 12, 31, 12, 34, 56)
CATEGORIES = {  # part type -> category as the shop names it
    "ECONOMY": "beleza_saude",
    "LARGE": "informatica_acessorios",
    "MEDIUM": "automotivo",
    "PROMO": "cama_mesa_banho",
    "STANDARD": "sem_traducao",
}
ENGLISH = {  # category -> its English name
    "beleza_saude": "health_beauty",
    "informatica_acessorios": "computers_accessories",
    "automotivo": "auto",
    "cama_mesa_banho": "bed_bath_table",
    "sem_categoria": "uncategorized",
}
PAID_BY = {"1": "credit_card", "2": "boleto", "3": "voucher", "4": "not_defined", "5": "debit_card"}


# The columns of the test tables; naming them saves reading file footers while planning.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_reads(spark)
    short_shuffles(spark)
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def _state(nation_key: str) -> Column:
    known = F.get(F.array(*[F.lit(s) for s in STATES]), F.col(nation_key))
    return F.when(F.col(nation_key) == 24, "XX").when(F.col(nation_key) < 23, known)


def _stamped(df: DataFrame, entity: str, op: Column, commit: Column) -> DataFrame:
    return df.withColumns({OP: op, COMMIT_TS: commit.cast("timestamp_ntz")}).select(
        *ENTITIES[entity].change_schema.fieldNames()
    )


def _purchase() -> Column:
    seconds = (F.col("o_orderkey") % 86400).cast("int")
    moved = F.timestamp_add("SECOND", seconds, F.col("o_orderdate"))
    return F.when(F.col("o_orderkey") % 997 != 0, moved)


def _later(ts: Column, unit: str, n: Column) -> Column:
    return F.timestamp_add(unit, n.cast("int"), ts)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    rows = rows.select(
        F.concat(F.lit("C"), "o_orderkey").alias("customer_id"),
        F.concat(F.lit("U"), "o_custkey").alias("customer_unique_id"),
        (F.col("c_custkey") * 7 % 99999).alias("customer_zip_code_prefix"),
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("customer_city"),
        _state("c_nationkey").alias("customer_state"),
        _purchase().alias("_bought"),
    )
    return _stamped(rows, "customers", F.lit("I"), F.col("_bought"))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("S"), "s_suppkey").alias("seller_id"),
        (F.col("s_suppkey") * 11 % 99999).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        _state("s_nationkey").alias("seller_state"),
    )
    return _stamped(rows, "sellers", F.lit("I"), F.lit(LOAD_TS))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), key).alias("product_id"),
        _lookup(CATEGORIES, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        F.col("p_retailprice").alias("product_description_lenght"),
        (key % 7).cast("double").alias("product_photos_qty"),
        (F.col("p_size") - 2).cast("double").alias("product_weight_g"),
        F.when(key % 10 != 0, key % 60 - 1).cast("double").alias("product_length_cm"),
        (key % 50).cast("double").alias("product_height_cm"),
        F.col("p_size").cast("double").alias("product_width_cm"),
    )
    return _stamped(rows, "products", F.lit("I"), F.lit(LOAD_TS))


def product_category_name_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories in use that have an English name, plus the one for products without category."""
    used = table(spark, sf_dir, "part").select(
        F.coalesce(_lookup(CATEGORIES, F.col("p_type")), F.lit("sem_categoria")).alias("product_category_name")
    )
    rows = (
        used.distinct()
        .withColumn("product_category_name_english", _lookup(ENGLISH, F.col("product_category_name")))
        .filter(F.col("product_category_name_english").isNotNull())
    )
    return _stamped(rows, "product_category_name_translation", F.lit("I"), F.lit(LOAD_TS))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderkey") % 50 == 0, "bogus")
        .otherwise("processing")
    )
    rows = table(spark, sf_dir, "orders").withColumn("bought", _purchase())
    bought, key = F.col("bought"), F.col("o_orderkey")
    rows = rows.select(
        F.concat(F.lit("O"), key).alias("order_id"),
        F.concat(F.lit("C"), key).alias("customer_id"),
        status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        _later(bought, "HOUR", F.lit(1)).alias("order_approved_at"),
        _later(bought, "DAY", F.lit(2)).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "F", _later(bought, "DAY", key % 40)).alias("order_delivered_customer_date"),
        _later(F.to_date(bought).cast("timestamp_ntz"), "DAY", F.lit(20)).alias("order_estimated_delivery_date"),
    )
    commit = F.coalesce("order_delivered_customer_date", "order_purchase_timestamp")
    return _stamped(rows, "orders", F.lit("I"), commit)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    op = (
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "D")
        .when(F.col("l_returnflag") == "A", "U")
        .otherwise("I")
    )
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("O"), "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.concat(F.lit("P"), "l_partkey").alias("product_id"),
        F.concat(F.lit("S"), "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(F.col("l_partkey") % 500 == 0, -price).otherwise(price).alias("price"),
        F.round(F.col("l_quantity") * 0.5, 2).alias("freight_value"),
        op.alias("_op"),
        _later(F.col("l_shipdate"), "SECOND", F.col("l_partkey")).alias("_at"),
    )
    return _stamped(rows, "order_items", F.col("_op"), F.col("_at"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.struct(
        F.lit(1).alias("payment_sequential"),
        _lookup(PAID_BY, F.substring("o_orderpriority", 1, 1)).alias("payment_type"),
        (F.col("o_orderkey") % 13).cast("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )
    second = F.struct(
        F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.lit(10.0).alias("payment_value"),
    )
    paid = F.when(F.col("o_orderkey") % 23 == 0, F.array(first, second)).otherwise(F.array(first))
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), "o_orderkey").alias("order_id"), _purchase().alias("_bought"), F.inline(paid)
    )
    return _stamped(rows, "payments", F.lit("I"), F.col("_bought"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    shared = F.when(key % 10 < 2, key - key % 2).otherwise(key)
    order = F.when((key % 10).isin(4, 5), key - key % 2).otherwise(key)
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("R"), shared).alias("review_id"),
        F.concat(F.lit("O"), order).alias("order_id"),
        (F.floor("value") % 7).cast("int").alias("review_score"),
        F.when(key % 3 != 0, F.concat(F.lit("title "), key)).alias("review_comment_title"),
        F.when(key % 2 != 0, F.col("props")).alias("review_comment_message"),
        F.to_date("ts").alias("review_creation_date"),
        _later(F.col("ts"), "HOUR", key % 72).alias("review_answer_timestamp"),
    )
    return _stamped(rows, "reviews", F.lit("I"), F.col("review_creation_date"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a keyed change log: sign-ups insert, errors delete, everything else updates."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value", op.alias(OP), F.col("ts").alias(COMMIT_TS)
    )


_READERS = {
    f.__name__: f
    for f in (
        customers,
        sellers,
        products,
        product_category_name_translation,
        orders,
        order_items,
        payments,
        reviews,
    )
}


def changes(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Change rows of an entity as they would land."""
    return _READERS[entity](spark, sf_dir)


def received(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Change rows with the time they were received: their commit day (else the day of the run) at the run's clock."""
    day = F.coalesce(F.to_date(COMMIT_TS), F.lit(NOW.date()))
    return changes(spark, sf_dir, entity).withColumn("_ingested_at", on_day(day, NOW))
